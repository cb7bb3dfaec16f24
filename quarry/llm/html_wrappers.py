"""Main-text extraction by wrappers: union-free regular expressions over the element streams of a host's pages.

A page is read as a stream of elements and texts.  Its own expression comes from folding: neighbouring groups of equal
elements become one repeated group.  The pages of a host are aligned one after the other with the expression so
far.  Texts that differ become slots, elements that only one side has become optional, and what then stands
side by side in equal groups folds into a repeated group.  There are no alternatives (no unions): a
sequence that stays irregular becomes a repeated group of optional members.  Tasks infer one expression a host
of what they read, and the expressions are aligned with each other, a few at a time, until one a host is left.

The wrapper says where the article is.  Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are known by element, class, id and role; one that holds the article is a layout and stays.
Every other text place gets a level: inside an article element, a main element, an element
named like content, or none of these; a page gives the texts of the best level it has.  Where nothing marks the
article, texts that are the same on all aligned pages of the host are template, provided that others differ.

Defined cases: a null page is empty, a page without text gives ''; a null or unreadable URL is host ''; unclosed and
unopened tags are read as browsers do (a paragraph ends where a block starts, an end tag without its start is nothing); a tag
cut off by the end of the page is dropped; <br> is white space inside its block; white space is that of
Unicode; equal page ids are rows each.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import extend_batches, texts_of
from quarry.session import materialize

# fixed values: element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
HEAD = frozenset("base link meta noscript script style template title".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCK - frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead tr".split()) | {"li", "dd", "dt"}
CELLS = frozenset("caption table td th".split())
# element -> elements that it ends when they are open, up to a bounding element
ENDS = {"li": (frozenset(["li"]), frozenset("menu ol ul".split()) | CELLS),
        "dt": (frozenset("dd dt".split()), frozenset(["dl"]) | CELLS), "dd": (frozenset("dd dt".split()), frozenset(["dl"]) | CELLS),
        "option": (frozenset(["option"]), frozenset("optgroup select".split())),
        "td": (frozenset("td th".split()), frozenset(["table"])), "th": (frozenset("td th".split()), frozenset(["table"])),
        "tr": (frozenset(["tr"]), frozenset(["table"])), "tbody": (frozenset("tbody tfoot thead".split()), frozenset(["table"])),
        "tfoot": (frozenset("tbody tfoot thead".split()), frozenset(["table"])),
        "thead": (frozenset("tbody tfoot thead".split()), frozenset(["table"]))}

# fixed values: what is never article text
SKIP_TAGS = frozenset("""aside audio button canvas dialog fieldset footer form head iframe input math menu nav noembed noframes noscript object
script search select style svg template textarea title video xmp""".split())
SKIP_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
toolbar""".split())
SKIP_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense alert banner breadcrumb breadcrumbs consent cookie
cookies copyright foot footer footnav form gdpr legal login menu modal nav navbar navigation newsletter notice notices notification
overlay pager pagination popup promo promotion recommended related search share sharing sidebar sidenav signup skip social sponsor
sponsored sticky subscribe subscription toolbar topbar widget widgets""".split())
COMMENT_WORDS = frozenset("comment commentlist comments disqus discussion replies reply respond responses".split())
HEADER_WORDS = frozenset("header masthead".split())
CONTENT_WORDS = frozenset("""article articlebody article-body article-content article-text body-text content entry-content main main-content
maincontent page-content post post-body post-content post-text story story-body text""".split())

TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*"[^"]*"|=\s*'[^']*'|=)*+)(>?)|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*>?""",
                 re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in RAW}
MAX_GROUP = 8  # longest group tried as a repetition
MAX_DEPTH = 200  # an element that would open deeper takes the place of the innermost one, as browsers do
MAX_SEQUENCE = 64  # a longer sequence becomes one repeated group of optional members
ARTICLE, MAIN, NAMED, PLAIN, DROPPED = 1, 2, 3, 4, 0


@lru_cache(maxsize=65_536)
def label_of(tag: str, attributes: str) -> str:
    """Element with its class, id and role, digits as one '#': ``div.post.wide#main@role``."""
    found = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "").lower())
    plain = {k: re.sub(r"\d+", "#", v) for k, v in found.items()}
    out = tag + "".join("." + w for w in sorted(set(plain.get("class", "").split())))
    for key, mark in (("id", "!"), ("role", "@"), ("itemprop", "$")):
        if plain.get(key, "").strip():
            out += mark + plain[key].strip().replace(" ", "_")
    return out


@lru_cache(maxsize=65_536)
def kind_of(label: str) -> tuple[str, int, bool]:
    """What to skip it as ('tag', 'name', 'comment', 'header' or ''), its content level, whether it is a block."""
    tag = re.match(r"[^.!@$]*", label)[0]
    names = re.findall(r"[.!]([^.!@$]+)", label)
    role = re.findall(r"[@$]([^.!@$]+)", label)
    words = {w for n in names for w in re.split(r"[^a-z]+", n)}
    if tag in SKIP_TAGS or SKIP_ROLES & set(role):
        return "tag", PLAIN, tag in BLOCK
    level = PLAIN
    if COMMENT_WORDS & words:
        return "comment", level, tag in BLOCK
    if tag == "article" or {"article", "articlebody"} & set(role):
        level = ARTICLE
    elif tag == "main" or "main" in role:
        level = MAIN
    elif tag in BLOCK and tag not in ("body", "html") and any(n.replace("_", "-") in CONTENT_WORDS for n in names):
        level = NAMED
    if tag in ("body", "html") or level in (ARTICLE, MAIN):
        return "", level, True
    if SKIP_WORDS & words:
        return "name", level, tag in BLOCK
    return ("header" if tag == "header" or HEADER_WORDS & words else ""), level, tag in BLOCK


def read_page(page: str) -> Iterator[tuple[str, str]]:
    """('open', label), ('close', label), ('text', raw text) and ('space', '') with the tags that HTML implies."""
    stack: list[tuple[str, str]] = []  # open elements: (tag, label)

    def close_to(n: int) -> Iterator[tuple[str, str]]:
        while len(stack) > n:
            yield "close", stack.pop()[1]

    def find(tags: Iterable[str], bounds: Iterable[str]) -> int:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in bounds:
                return -1
        return -1

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if m is None:
            yield "text", page[at:]
            break
        if m.start() > at:
            yield "text", page[at:m.start()]
        at = m.end()
        if not m[2] or not m[4]:  # a comment or declaration, or a tag cut off by the end
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in ("body", "html"):
                continue
            if tag in BLOCK or tag in CELLS:
                i = find((tag,), () if tag in CELLS or tag in ENDS else CELLS)
            else:
                i = find((tag,), BLOCK)
            if i >= 0:
                yield from close_to(i)
            elif tag in BLOCK:  # a stray end tag still ends the block of text
                yield "open", tag
                yield "close", tag
            continue
        if tag not in HEAD and stack and stack[-1][0] == "head":
            yield from close_to(len(stack) - 1)
        if tag in ENDS_P:
            i = find(("p",), CELLS | {"button", "object"})
            if i >= 0:
                yield from close_to(i)
        if tag in ENDS:
            i = find(*ENDS[tag])
            if i >= 0:
                yield from close_to(i)
        if tag in ("html", "body") and any(t == tag for t, _ in stack):
            continue
        if tag == "br":
            yield "space", ""
            continue
        label = label_of(tag, m[3])
        if tag in VOID:
            if tag == "hr":
                yield "open", label
                yield "close", label
            continue
        if len(stack) >= MAX_DEPTH:
            yield from close_to(MAX_DEPTH - 1)
        yield "open", label
        if tag in RAW:
            end = RAW_ENDS[tag].search(page, at)
            at = end.end() if end else size
            yield "close", label
        elif m[3].endswith("/") and tag in ("svg", "math"):
            yield "close", label
        else:
            stack.append((tag, label))
    yield from close_to(0)


# -- expressions: [label, repeated, optional, text hash (0: slot), members]; label '#' is a text, '(..)' a group


def _merge(a: list, b: list) -> list:
    """The expression of two with the same label."""
    return [a[0], a[1] or b[1], a[2] or b[2], a[3] if a[3] == b[3] else 0, align(a[4], b[4]) if a[4] or b[4] else []]


def _fold(seq: list[list]) -> list[list]:
    """Equal neighbouring groups of up to MAX_GROUP members become one repeated member."""
    for length in range(1, MAX_GROUP + 1):
        if len(seq) < 2 * length:
            break
        out: list[list] = []
        i = 0
        names = [n[0] for n in seq]
        while i < len(seq):
            group = names[i:i + length]
            j = i + length
            while length <= len(seq) - j and names[j:j + length] == group:
                j += length
            if j == i + length:
                out.append(seq[i])
                i += 1
                continue
            whole = seq[i:i + length]
            for k in range(i + length, j, length):
                whole = [_merge(a, b) for a, b in zip(whole, seq[k:k + length])]
            if length == 1:
                out.append([whole[0][0], True, *whole[0][2:]])
            else:
                out.append(["(" + " ".join(group) + ")", True, False, 0, whole])
            i = j
        seq = out
    return _irregular(seq) if len(seq) > MAX_SEQUENCE else seq


def _irregular(seq: list[list]) -> list[list]:
    """One repeated group with every distinct member once, optional: (a? b? c?)+."""
    members: dict[str, list] = {}
    for n in seq:
        for one in n[4] if n[0].startswith("(") else [n]:
            members[one[0]] = _merge(members[one[0]], one) if one[0] in members else one
    return [["(*)", True, False, 0, [[m[0], m[1], True, *m[3:]] for _, m in sorted(members.items())]]]


def align(a: list[list], b: list[list]) -> list[list]:
    """The sequence that covers both: equal members meet, the others are optional, then equal groups fold."""
    left, right = [n[0] for n in a], [n[0] for n in b]
    if "(*)" in left or "(*)" in right:
        return _irregular(a + b)
    if left == right:
        return [_merge(x, y) for x, y in zip(a, b)]
    out = []
    for what, i, j, k, m in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if what == "equal":
            out += [_merge(x, y) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += [[*n[:2], True, *n[3:]] for n in a[i:j] + b[k:m]]
    return _fold(out)


def page_expression(page: str) -> list:
    """The page as an expression over its block elements, named inline elements and texts."""
    root: list = ["", False, False, 0, []]
    open_: list[tuple[list, list[str]]] = [(root, [])]

    def settle(node: list, pieces: list[str]) -> None:
        text = "".join(pieces).strip()
        if text:
            node[4].append(["#", False, False, xxhash.xxh64_intdigest(text) or 1, []])
        pieces.clear()

    for what, value in read_page(page):
        if what == "text":
            open_[-1][1].append(value)
        elif what == "space":
            open_[-1][1].append(" ")
        elif _structural(value):
            if what == "open":
                settle(*open_[-1])
                open_.append(([value, False, False, 0, []], []))
            else:
                node, pieces = open_.pop()
                settle(node, pieces)
                node[4] = _fold(node[4])
                open_[-1][0][4].append(node)
    settle(*open_[0])
    root[4] = _fold(root[4])
    return root


@lru_cache(maxsize=65_536)
def _structural(label: str) -> bool:
    """Inline elements count only where a class, id or role names them, or where they are skipped."""
    skip, _, block = kind_of(label)
    return block or skip != "" or bool(re.search(r"[.!@$]", label))


def expression_text(node: list) -> str:
    """The wrapper as a regular expression over elements: ``+`` repeated, ``?`` optional, ``*`` both, ``_`` a text slot."""
    label, many, maybe, text, members = node
    inner = " ".join(expression_text(m) for m in members)
    if label == "#":
        body = "_" if text == 0 else f"'{text:x}'"
    elif label.startswith("("):
        body = f"({inner})"
    else:
        body = f"<{label}>{inner}</>" if label else inner
    return body + ("*" if many and maybe else "+" if many else "?" if maybe else "")


@lru_cache(maxsize=65_536)
def _step(path: int, label: str) -> int:
    digest = xxhash.xxh64_intdigest(label, seed=path)
    return digest - (1 << 64) if digest >> 63 else digest


def step(path: int, label: str) -> int:
    """64 bits that name a place: the labels from the root to an element."""
    return _step(path & (1 << 64) - 1, label)


def _holds_content(node: list) -> bool:
    skip, level, _ = kind_of(node[0]) if node[0] not in ("", "#") and not node[0].startswith("(") else ("", PLAIN, False)
    return skip not in ("tag", "comment") and (level in (ARTICLE, MAIN) or any(_holds_content(m) for m in node[4]))


def wrapper_levels(wrapper: list) -> dict[int, int]:
    """Place -> level of every text place of a wrapper (DROPPED: not article text)."""
    levels: dict[int, int] = {}
    fixed: dict[int, bool] = {}  # place -> all of its texts are the same on all pages

    def walk(node: list, path: int, level: int) -> None:
        label = node[0]
        if label == "#":
            levels[path] = level
            fixed[path] = fixed.get(path, True) and node[3] != 0
            return
        if label and not label.startswith("("):
            path = step(path, label)
            skip, own, _ = kind_of(label)
            if level != DROPPED:
                dropped = skip in ("tag", "comment") or (skip == "name" and not _holds_content(node)) or (
                    skip == "header" and level not in (ARTICLE, MAIN) and not _holds_content(node))
                level = DROPPED if dropped else min(level, own)
        for m in node[4]:
            walk(m, path, level)

    walk(wrapper, 0, PLAIN)
    plain = [p for p, level in levels.items() if level == PLAIN]
    if any(not fixed[p] for p in plain):
        for p in plain:
            if fixed[p]:
                levels[p] = DROPPED
    return levels


def main_text(page: str, levels: dict[int, int]) -> str:
    """Blocks of the best level that the page has, joined by newlines."""
    blocks: dict[int, list[str]] = {ARTICLE: [], MAIN: [], NAMED: [], PLAIN: []}
    pieces: dict[int, list[str]] = {}
    path, above = 0, []

    def settle() -> None:
        for level, parts in pieces.items():
            text = " ".join("".join(parts).split())
            if text:
                blocks[level].append(text)
        pieces.clear()

    for what, value in read_page(page):
        if what == "text":
            level = levels.get(path, PLAIN)
            if level != DROPPED:
                pieces.setdefault(level, []).append(html.unescape(value) if "&" in value else value)
        elif what == "space":
            for parts in pieces.values():
                parts.append(" ")
        elif _structural(value):
            if kind_of(value)[2]:
                settle()
            if what == "open":
                above.append(path)
                path = step(path, value)
            else:
                path = above.pop()
    settle()
    return next(("\n".join(b) for _, b in sorted(blocks.items()) if b), "")


def _host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return host


INFERRED = pa.schema([("host", pa.string()), ("pages", pa.int64()), ("expression", pa.string())])


def _infer(max_hosts: int):
    """(host, html) -> one expression a host and task (held hosts leave early when there are ``max_hosts``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        counts: dict[str, int] = {}

        def leave() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict({"host": list(held), "pages": [counts[h] for h in held],
                                              "expression": [json.dumps(e, separators=(",", ":")) for e in held.values()]},
                                             schema=INFERRED)
            held.clear()
            counts.clear()
            return out

        for b in batches:
            for host, page in zip(b.column(0).to_pylist(), texts_of(b, "html")):
                own = page_expression(page.decode("utf-8", "replace"))
                held[host] = _merge(held[host], own) if host in held else own
                counts[host] = counts.get(host, 0) + 1
                if len(held) == max_hosts:
                    yield leave()
        if held:
            yield leave()

    return run


def _align_all(key: tuple, table: pa.Table) -> pa.Table:
    """Expressions of one host (and share of it) -> one; in the order of their texts, so that reruns agree."""
    rows = sorted(zip(table.column("expression").to_pylist(), table.column("pages").to_pylist()))
    whole = json.loads(rows[0][0])
    for text in sorted({t for t, _ in rows})[1:]:
        whole = _merge(whole, json.loads(text))
    return pa.table({"host": [key[0].as_py()], "pages": [sum(n for _, n in rows)],
                     "expression": [json.dumps(whole, separators=(",", ":"))]}, schema=INFERRED)


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", shares: int = 64,
                   max_hosts: int = 20_000) -> DataFrame:
    """host, pages, expression (JSON) of every host, over all of its pages.

    Expressions of a host meet in two steps, first in ``shares`` by task, so that a host of any size is aligned by many tasks.
    """
    slim = pages.select(_host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    schema = "host string, pages long, expression string"
    part = slim.mapInArrow(_infer(max_hosts), schema).withColumn("share", F.pmod(F.spark_partition_id(), F.lit(shares)))
    return (part.groupBy("host", "share").applyInArrow(_align_all, schema)
            .groupBy("host").applyInArrow(_align_all, schema))


def wrappers_text(wrappers: DataFrame) -> DataFrame:
    """host, pages and the wrapper in its readable form."""

    def make():
        def fn(b: pa.RecordBatch) -> dict[str, pa.Array]:
            return {"wrapper": pa.array([expression_text(json.loads(e)) for e in texts_of(b, "expression")], pa.string())}

        return fn

    return extend_batches(wrappers, make, [T.StructField("wrapper", T.StringType())]).select("host", "pages", "wrapper")


def _place_levels(wrappers: DataFrame) -> DataFrame:
    """host -> its places and their levels, as two packed arrays."""

    def make():
        def fn(b: pa.RecordBatch) -> dict[str, pa.Array]:
            levels = [sorted(wrapper_levels(json.loads(e)).items()) for e in texts_of(b, "expression")]
            return {"places": pa.array([[p for p, _ in found] for found in levels], pa.list_(pa.int64())),
                    "levels": pa.array([bytes(n for _, n in found) for found in levels], pa.binary())}

        return fn

    fields = [T.StructField("places", T.ArrayType(T.LongType())), T.StructField("levels", T.BinaryType())]
    return extend_batches(wrappers.select("host", "expression"), make, fields).select("host", "places", "levels")


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` without the HTML, with ``text`` and ``n_chars`` (code points).

    The wrappers are written first, so that their size is known: below Spark's threshold they are broadcast, above it
    pages and wrappers shuffle by host and hot hosts are split.
    """
    rules = materialize(_place_levels(materialize(infer_wrappers(pages, url_col, html_col), "wrappers")), "wrapper-levels")
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.coalesce(F.col(html_col), F.lit("")).alias("html"),
                        _host(F.col(url_col)).alias("host"))

    def make():
        known: dict[tuple, dict[int, int]] = {}

        def levels_of(places: list[int], levels: bytes) -> dict[int, int]:
            key = (tuple(places), levels)
            if key not in known:
                if len(known) > 10_000:
                    known.clear()
                known[key] = dict(zip(places, levels))
            return known[key]

        def fn(b: pa.RecordBatch) -> dict[str, pa.Array]:
            rules = zip(b.column(b.schema.get_field_index("places")).to_pylist(), b.column(b.schema.get_field_index("levels")).to_pylist())
            texts = [main_text(page.decode("utf-8", "replace"), levels_of(places, levels))
                     for page, (places, levels) in zip(texts_of(b, "html"), rules)]
            return {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "html": pa.nulls(b.num_rows, pa.string())}

        return fn

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("html", T.StringType())]
    done = extend_batches(rows.join(rules, "host"), make, fields)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], "text", "n_chars")
