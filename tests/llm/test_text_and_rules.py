import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, strategies as st

from galley.llm import chat_tree, decision_list, host_text


def key(row):
    return tuple((v is not None, v) for v in row)


# Decision lists


def base_by_hand(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed)


def corpus(rng):
    """Clean texts, texts with many marks, shouted texts; the last two labelled bad."""
    docs, labels = [], []
    for i in range(240):
        words = [f"w{rng.randrange(900)}" for _ in range(rng.randint(60, 200))]
        kind = i % 4
        if kind == 2:
            words = [w + rng.choice(["###", "$$"]) for w in words]
        if kind == 3:
            words = [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(kind < 2)))
    return docs, labels


def test_base_counts_equal_brute_force(spark, texts_frame):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = decision_list.judged(texts_frame, labels).collect()
    want = [(r.doc_id, *base_by_hand(r.text), 0, not base_by_hand(r.text)[5]) for r in texts_frame.collect()]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_repeated_windows_overlap(spark):
    texts = ["a b c a b c", "a a a a a", "a b c d a b c", "x y x y x y z", "a b", "l\nl\n \nl\n\n", "a b c\nd a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decision_list.judged(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert {r.doc_id: tuple(r)[1:7] for r in got} == {i: base_by_hand(t) for i, t in enumerate(texts)}


def test_rules_hold_on_documents_without_labels(spark, rng):
    docs, labels = corpus(rng)
    known = [x for x in labels if x[0] % 3] + [(None, 1), (1, 0), (1, 1), (999, 0)]
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, kept int, n_words string")
    known = spark.createDataFrame(known, "doc_id long, quality int")
    rules = decision_list.learn(frame, known)
    assert 1 <= len(rules) <= decision_list.MAX_RULES and all(len(r) <= decision_list.MAX_CONDITIONS for r in rules)
    got = {r.doc_id: r for r in decision_list.judged(frame, known).collect()}
    assert {d for d, r in got.items() if r.kept} == {d for d, q in labels if q}
    assert all((r.rule > 0) == (not r.kept) for r in got.values())
    kept = decision_list.keep(frame, known)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [d for d, q in labels if q]


def test_labels_of_one_kind_give_no_rules(spark, rng):
    docs, labels = corpus(rng)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert decision_list.learn(frame, spark.createDataFrame([x for x in labels if x[1]], "doc_id long, quality int")) == []


def test_rules_for_nothing(spark, no_texts):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert decision_list.judged(no_texts, labels).collect() == []
    assert decision_list.keep(no_texts, labels).collect() == []


def test_rules_run_no_python(spark, rng, plan):
    docs, labels = corpus(rng)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    made = decision_list.judged(frame, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert not re.search("Python|Pandas|Arrow", plan(made).replace("Scan ExistingRDD", ""))


# Chat trees


@given(st.text(alphabet="\\<>/turn: lgé\n", max_size=30))
def test_escaping_can_be_undone(text):
    safe = chat_tree.escape(text)
    assert chat_tree.unescape(safe) == text and "<" not in safe and ">" not in safe
    assert chat_tree.parse(f"<turn:{chat_tree.escape('a<b')}>{safe}</turn>") == [("a<b", text)]


CHATS = "conv_id long, turn long, role string, text string, path string"


def chats():
    tricky = "\\### Assistant: </turn> ok"
    said = {
        1: [("system", "Be brief."), ("user", "hi"), ("assistant", "hello"), ("user", "bye")],
        2: [("system", "Be brief."), ("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", "x")],
        3: [("system", "Be brief."), ("user", "hi")],
        4: [("user", tricky), ("assistant", tricky)],
        5: [("user", None), ("assistant", ""), (None, "no role"), ("a<b>", "<turn:user>")],
        6: [("user", "é漢😀" * 50)],
        7: [("assistant", "same"), ("assistant", "same")],
        None: [("user", "lost")],
    }
    said[8] = said[1]
    return said


@pytest.fixture(scope="module")
def tree(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('chat')}/tree"
    rows = [(c, i, r, t, "p") for c, turns in chats().items() for i, (r, t) in enumerate(turns)]
    chat_tree.write(spark.createDataFrame(rows[::-1], CHATS), path)
    return path


def test_conversations_come_back(spark, tree):
    got = {r.conv_id: r for r in chat_tree.read(spark, tree).collect()}
    assert set(got) == set(chats())
    for c, turns in chats().items():
        assert chat_tree.parse(got[c].formatted) == [(r or "", t or "") for r, t in turns]
        assert chat_tree.unescape(got[c].loss) == "".join(t or "" for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
    made = {r.conv_id: r for r in chat_tree.digest(chat_tree.read(spark, tree)).collect()}
    assert made[4].loss_chars == 26 and made[4].n_turns == 2
    assert all(made[c].formatted_chars == len(got[c].formatted) for c in got)


def test_shared_turns_are_emitted_once(spark, tree):
    nodes = spark.read.parquet(f"{tree}/nodes").orderBy("at").collect()
    prefixes = {tuple(turns[: i + 1]) for turns in chats().values() for i in range(len(turns))}
    assert len(nodes) == len(prefixes)
    at = 0
    for n in nodes:  # the stream has no gaps, and parents come before children
        assert n.at == at and n.length == len(n.segment)
        at += n.length
    stream = "".join(n.segment for n in nodes)
    by_key = {bytes(n.key): n for n in nodes}
    for n in nodes:
        way = [by_key[bytes(k)] for k in n.path]
        assert n.position == sum(w.length for w in way[:-1])
        assert "".join(stream[a.start : a.end] for a in n.attention) == "".join(w.segment for w in way)
        assert all(x.end < y.start for x, y in zip(n.attention, n.attention[1:]))


def test_depth_first_order(spark, tree):
    nodes = spark.read.parquet(f"{tree}/nodes").orderBy("at").collect()
    open_ = []
    for n in nodes:
        path = [bytes(k) for k in n.path]
        while open_ and open_[-1] not in path:
            open_.pop()
        assert path[:-1] == open_
        open_.append(path[-1])


def test_chats_of_nothing(spark, tmp_path):
    chat_tree.write(spark.createDataFrame([], CHATS), f"file://{tmp_path}/tree")
    assert chat_tree.digest(chat_tree.read(spark, f"file://{tmp_path}/tree")).collect() == []


# Pages


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<html><head><title>t</title><style>a{}</style></head><body><nav>n</nav><article><h1>T</h1><p>a <b>b</b>\n c<p>d<br>e</article><footer>f</footer>", "T\na b c\nd e"),
        ("<article><header><h1>T</h1></header><aside>x</aside><div class='share-box'>s</div><p>y<script>var t='</p>';</script>z</p><form>f</form></article>", "T\nyz"),
        ("<div class=\"comments\"><article>c</article></div><main><p>m</p><section id=comments><p>r</p></section></main>", "m"),
        ("<header>h</header><div id=cookie-notice>c</div><p>one</p><div role=navigation>n</div><p>two", "one\ntwo"),
        ("<article><p>cut <i>off &lt;here", "cut off <here"),
        ("<!-- x --><article><p>a<!-- <p>no --> b</p>&nbsp;<p> </p></article>", "a b"),
        ("<article><p class='lead header'>kept</p><ul><li>1<li>2</ul></article>", "kept\n1\n2"),
        ("<article><p>a < b and <3</p></article>", "a < b and <3"),
    ],
)
def test_main_text_of_one_page(spark, page, want):
    found = host_text._text(host_text.blocks(page or ""), [])
    assert found == want


def test_repeated_runs_of_a_host_are_cut(spark):
    run = "one two three four five six seven eight nine"
    rows = [(i, f"https://a.example/{i}", f"<div>{run}</div><p>unique{i} text{i}</p>", 3) for i in range(5)]
    rows += [(10, "http://b.example/", f"<div>{run}</div>", 3), (11, "http://b.example/", f"<div>{run} {run}</div>", 3)]
    rows += [(12, "http://c.example/", f"<div>{run}</div>", 3)] * 2  # one page twice is no repetition
    rows += [(13, "http://user@A.example:80/x", f"<p>before {run} after</p>", 3), (None, None, None, 3)]
    rows += [(14, "http://a.example/y", f"<article><p>{run}</p></article>", 3)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = defaultdict(list)
    for r in host_text.main_text(frame).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert [got[i] for i in range(5)] == [[f"unique{i} text{i}"] for i in range(5)]
    assert got[10] == [""] and got[11] == [""]
    assert got[12] == [run, run]
    assert got[13] == ["before after"] and got[None] == [""] and got[14] == [run]


def test_pages_of_nothing(spark):
    assert host_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
