"""Main text of web pages: structure first, then repeated runs across the pages of a host.

A page is cut into blocks at block-level tags. A block's zone follows from the elements around it:

main    inside ``article`` or ``main``
chrome  inside navigation, page headers and footers, asides, forms, or elements whose class, id
        or role names such a part, an advert, a notice or reader comments; also inside an article
free    anything else

A page that has main blocks consists of them, otherwise of its free blocks. Inside an article
boilerplate is known first by the names of elements, paragraphs and list items among them. Then
repetition decides on every page: the token streams of all pages, all blocks in page order, are
concatenated by host, and runs of ``RUN`` tokens and more that occur on two different pages of the
host (see ``suffix_dedup``: sampled suffixes, sorted externally) are boilerplate. Covered tokens
are cut out of the blocks that make the text, unique runs are kept.

Work per host is spread over the names of its runs; a host with a third of all pages is no group.

* null html counts as empty and gives empty text; pages without a url are of the host ""
* repeated rows each give a row and count as one page for repetition; null ids take part
* unclosed and unknown elements, cut-off pages and stray marks are read as browsers do, roughly:
  an unclosed script, style, title, textarea, iframe or noscript takes the rest of the page; buttons,
  selects and templates are left out if they are closed; formulas and drawings are inline text
* other columns are ignored; an empty table gives no rows
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from galley.llm.common import Stage, map_batches
from galley.llm.rolling import words
from galley.llm.suffix_dedup import Unit, covered, repeated_starts

RUN = 8  # tokens
TOKENS = Unit("words", 3, 3)

# HTML elements by what they do to text.
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
_RAW = frozenset("script style title textarea iframe noscript".split())
_CONTROLS = {  # left out whole, if closed before the next one opens and within the main part
    tag: re.compile(rf"<(/?)({tag}|article|main|body)(?![\w:-])[^>]*>", re.IGNORECASE) for tag in ("button", "select")
} | {"template": re.compile(r"<(/?)(template)(?![\w:-])[^>]*>", re.IGNORECASE)}
_CHROME = frozenset("nav footer aside form dialog menu".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside footer masthead comment comments commentlist disqus reply replies respond related recommended share "
    "sharing social widget pagination pager toc skip".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_MARK = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>""", re.DOTALL
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)


def _is_chrome(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in _CHROME or (tag == "header" and not in_main):
        return True
    for name, *values in _NAMED.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if value.strip() in _ROLES:
                return True
        elif not in_main or tag not in ("article", "main", "body", "html"):
            parts = re.split(r"[\s_-]+", value)
            if any(p in _NAMES for p in parts) or (not in_main and tag not in ("p", "li") and "header" in parts):
                return tag not in ("html", "body")
    return False


def _end_item(open_: list[tuple[str, str | None]], closing: bool) -> None:
    """Close the innermost list item: by its mark unless a list is open inside, by the next item as browsers do."""
    for i in range(len(open_) - 1, -1, -1):
        tag = open_[i][0]
        if tag == "li":
            del open_[i:]
            return
        if tag in ("ul", "ol", "menu", "dir") or (not closing and tag not in ("p", "div", "address")):
            return


def _control_end(page: str, tag: str, at: int) -> int:
    """Where the control or template that opens before ``at`` ends; ``at`` if it is not closed."""
    inner = 0
    for found in _CONTROLS[tag].finditer(page, at):
        if found[2].lower() != tag or (not found[1] and tag != "template"):
            break
        if found[1] and not inner:
            return found.end()
        inner += -1 if found[1] else 1
    return at


def blocks(page: str) -> list[tuple[str, str]]:
    """``(zone, text)`` of the blocks of a page in order; white space is one blank, empty blocks are left out."""
    out: list[tuple[str, str]] = []
    parts: list[str] = []
    open_: list[tuple[str, str | None]] = []  # elements that decide zones, with the zone they begin
    zone, at, size = "free", 0, len(page)

    def end_block() -> None:
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append((zone, text))
        parts.clear()

    while at < size:
        found = _MARK.search(page, at)
        if not found:
            parts.append(page[at:])
            break
        parts.append(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        closing, attributes = bool(found[1] or found[4]), found[3] or found[6] or ""
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            end_block()
        if tag in _RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else size
            continue
        if tag in _CONTROLS:
            if not closing:
                at = _control_end(page, tag, at)
            continue
        if tag not in _BLOCK or tag in _VOID:
            continue
        if closing and tag == "li":
            _end_item(open_, True)
        elif closing:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == tag:
                    del open_[i:]
                    break
        else:
            if open_ and open_[-1][0] == "p":  # any block ends a paragraph
                open_.pop()
            if tag == "li":
                _end_item(open_, False)
            in_main = any(z == "main" for _, z in open_)
            own = "chrome" if _is_chrome(tag, attributes, in_main) else "main" if tag in ("article", "main") else None
            open_.append((tag, own))
        zones = [z for _, z in open_ if z]
        zone = "chrome" if "chrome" in zones else "main" if zones else "free"
    end_block()
    return out


def _stream(found: list[tuple[str, str]]) -> str:
    return "\n".join(text for _, text in found)


def _text(found: list[tuple[str, str]], runs: list[dict]) -> str:
    """Main blocks, or without any the free blocks, less the covered tokens of the page's stream."""
    wanted = "main" if any(zone == "main" for zone, _ in found) else "free"
    spans = covered(runs, RUN)
    cut = np.zeros(spans[-1][1] if spans else 0, dtype=bool)
    for a, b in spans:
        cut[a:b] = True
    out, at = [], 0
    for zone, text in found:
        data = text.encode()
        starts, ends = words(data)
        n = len(starts)
        if zone == wanted:
            own = np.zeros(n, dtype=bool)
            own[: len(cut[at : at + n])] = cut[at : at + n]
            kept = np.flatnonzero(~own).tolist()
            if len(kept) == n:
                out.append(text)
            elif kept:
                out.append(" ".join(data[starts[i] : ends[i]].decode() for i in kept))
        at += n
    return "\n".join(out)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (page_id, url, html)."""
    stage = Stage(pages.sparkSession, "pages")
    rows = pages.select(
        F.col("page_id").cast("long").alias("doc_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("text_key", F.xxhash64("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(page) for page in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([_stream(f) for f in found], pa.string()), batch.column(2)],
                ["doc_id", "text_key", "text", "scope"],
            )

    read = map_batches(
        rows.select("doc_id", "text_key", F.xxhash64(host).alias("scope"), "html"), streams,
        "doc_id long, text_key long, text string, scope long",
    )
    read = stage.save(read, "streams")
    runs = repeated_starts(read, RUN, TOKENS, stage, apart=True)
    wanted = stage.save(runs.select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"), "runs"), "wanted")
    stage.free("streams", "runs")
    joined = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["id_"]) & (rows["text_key"] == wanted["key_"]), "left")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_text(blocks(page), own or []) for page, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return map_batches(joined.select("doc_id", "url", "html", "runs"), extract, "page_id long, url string, text string, n_chars long")
