from galley.llm import chat_tree

CHATS = "conv_id long, turn long, role string, text string"


def test_trees_of_many_branches(spark, rng, tmp_path):
    """Depth-first order, attention and texts of conversations that branch at many depths."""
    said = {}
    for c in [None, *range(-3, 60)]:
        begin = list(rng.choice(list(said.values()))) if said and rng.random() < 0.9 else []
        begin = begin[: rng.randint(0, len(begin))]
        said[c] = begin + [(rng.choice(["user", "assistant"]), rng.choice(["a", "b<", "é😀"]) * rng.randint(0, 3)) for _ in range(rng.randint(1, 12))]
    rows = [(c, i, r, t) for c, turns in said.items() for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    path = f"file://{tmp_path}/tree"
    chat_tree.write(spark.createDataFrame(rows, CHATS), path)
    nodes = spark.read.parquet(f"{path}/nodes").orderBy("at").collect()
    assert len(nodes) == len({tuple(t[: i + 1]) for t in said.values() for i in range(len(t))})
    by_key, stream, open_ = {bytes(n.key): n for n in nodes}, "".join(n.segment for n in nodes), []
    at = 0
    for n in nodes:
        assert n.at == at
        at += n.length
        way = [n]
        while way[0].parent is not None:
            way.insert(0, by_key[bytes(way[0].parent)])
        keys = [bytes(w.key) for w in way]
        while open_ and open_[-1] not in keys:
            open_.pop()
        assert open_ == keys[:-1]
        open_.append(keys[-1])
        assert n.depth == len(way) - 1 and n.position == sum(w.length for w in way[:-1])
        assert [bytes(k) for k in n.path] == keys[n.depth - n.depth % chat_tree.RUN :]
        assert "".join(stream[a.start : a.end] for a in n.attention) == "".join(w.segment for w in way)
        assert all(x.end < y.start for x, y in zip(n.attention, n.attention[1:]))
    got = {r.conv_id: r for r in chat_tree.read(spark, path).collect()}
    assert {c: chat_tree.parse(r.formatted) for c, r in got.items()} == said
    whole = chat_tree.digest(chat_tree.read(spark, path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, chat_tree.read_digest(spark, path).collect()))


def test_a_long_conversation_does_not_grow_with_its_square(spark, tmp_path):
    """No row of 20,000 turns that nobody shares holds the way to it."""
    n = 20_000
    rows = spark.range(n).selectExpr("cast(null as long) conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('t', id) text")
    path = f"file://{tmp_path}/tree"
    chat_tree.write(rows, path)
    nodes = spark.read.parquet(f"{path}/nodes")
    found = nodes.selectExpr("count(*) n", "max(size(path)) path", "max(size(attention)) attention", "max(depth) depth").first()
    assert tuple(found) == (n, chat_tree.RUN, 1, n - 1)
    made = chat_tree.read_digest(spark, path).collect()
    assert [(r.conv_id, r.n_turns) for r in made] == [(None, n)]
    assert made[0].loss_chars == sum(len(f"t{i}") for i in range(1, n, 2))
