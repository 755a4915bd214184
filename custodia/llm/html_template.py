"""Main text of pages by deducing the templates of each host's layouts from equivalence classes.

Pages of a host with one skeleton, the upper elements, are a layout. Where too few pages
have a skeleton, all pages with the same elements below the body are taken for it, or else
all of the host; the template found there then only holds for the pages with few of a kind.

A token is an element with its path, or a text run with its. Its occurrence vector
holds how often it occurs in each page of the layout; tokens with one vector form an
equivalence class. A class counts if half of the layout's pages have it, and is
valid if its tokens keep one order on every page and it nests in one gap of the
class of tokens that every page has once. Valid classes make the template. What
lies between its tokens are slots, and the element of the template that holds the
article's slots is the layout's container: an article, else a main element, else the
innermost one with most of the text that is in slots. Blocks of the container that are
all template go as well, unless they are nearly all of the page's text there, as in near copies. The text of a page is what
its container holds, without elements that their kind tells to be other matter. A class,
id or role only proposes that: an element goes if its text is mostly links, if it is a
named article in an article, or if its name can't be a topic and it is in the template
and holds little of the slots' text; never if it holds the page's article or most text.

Vectors are counted over different pages: those with one sequence of tokens are one page,
and what only one page has is never template, so copies keep their text.

Vectors are never gathered: two sums of hashes over (page, count) stand for one, so
that a layout with any number of pages is summed up where its pages are read.

Defined results: a null or empty page has an empty text and is of no layout; a page without a url
belongs to the host of no name; repeated rows count once; a page that lacks
its layout's container is read by its own article or main element, or else its body;
a host with one page has a template like any other; an empty table gives an empty
table; only page_id, url and html are read. Pages are read whole.
"""

from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.html_page import (
    ARTICLE,
    CLUTTER,
    HANDED,
    HEADER,
    HEADING,
    LINK,
    MAIN,
    NAMED,
    OUTSIDE,
    POST,
    Page,
    join_blocks,
    parse,
    skeleton,
)
from custodia.storage import stage

#: Pages of one skeleton are a layout from this many on.
LAYOUT_PAGES = 3
#: Tokens of a class count if at least this share of the layout's pages has them.
SUPPORT = 0.5
#: A child takes over as container if it holds this share of the slots' text.
MASS = 0.6
#: What a name proposes goes if it holds at most this share of the slots' text.
LITTLE = 0.3
#: A container's blocks of template go if they hold at most this share of its text on the page.
REPEATED = 0.8
#: Text runs count as template from this many different pages on.
TEXT_PAGES = 2

_MASK = (1 << 63) - 1


def host(url: str = "url") -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z]+://([^/:?#]+)", 1), F.lit("")))


def text_token(parent: int, text: str) -> int:
    """A text run with its path."""
    return (parent * 0xD6E8FEB86659FD93 + crc32(text.strip().encode()) * 2 + 1) & _MASK


def tokens_of(page: Page) -> list[tuple[int, int, int, int, int]]:
    """Token, parent's position, text length, flags, and 1 for texts, in page order."""
    elements, texts = page.elements, page.texts
    rows, where = [], {0: -1}
    k, last = 0, len(texts)
    for i in range(1, len(elements) + 1):
        end = elements[i].start if i < len(elements) else 1 << 62
        while k < last and texts[k].start < end:
            text = texts[k]
            k += 1
            if text.text.strip():
                up = elements[text.parent]
                token = text_token(up.token, text.text)
                rows.append((token, where[text.parent], len(text.text), up.flags & HANDED, 1))
        if i < len(elements):
            e = elements[i]
            where[i] = len(rows)
            rows.append((e.token, where[e.parent], 0, e.flags, 0))
    return rows


def settle(
    parents: list[int],
    flags: list[int],
    lengths: list[int],
    links: list[int],
    slots: list[int],
    clutter: Callable[[int, int, int], bool],
) -> list[bool]:
    """Which elements are other matter, by kind or by a name that is confirmed.

    Parents come before their children. Lengths are of an element's own text, of it in
    links, and of it in slots outside of links. ``clutter`` confirms an element, by its
    text and all text in slots, whose name can't be a topic.
    """
    out = [bool(f & OUTSIDE) for f in flags]
    named = [i for i, f in enumerate(flags) if f & NAMED and not out[i]]
    if not named:
        return out
    sums = [[0 if gone else n for n, gone in zip(own, out, strict=True)] for own in (lengths, links, slots)]
    whole, linked, slot = sums
    total, in_slots = sum(whole), sum(slot)
    for i in range(len(parents) - 1, -1, -1):
        if parents[i] >= 0:
            for one in sums:
                one[parents[i]] += one[i]
    under = [bool(f & NAMED) for f in flags]
    for i, up in enumerate(parents):
        under[i] |= up >= 0 and under[up]
    # The page's article is the largest, of those without a name around them if there are any.
    held: set[int] = set()
    for flag in (ARTICLE, MAIN):
        marked = [i for i, f in enumerate(flags) if f & flag and not out[i]]
        marked = [i for i in marked if parents[i] < 0 or not flags[parents[i]] & flag]
        if marked:
            at = max([i for i in marked if not under[i]] or marked, key=lambda i: (whole[i], -i))
            while at >= 0:
                held.add(at)
                at = parents[at]
            break
    for i in named:
        if i in held or 2 * whole[i] > total or not whole[i]:
            continue
        nested = flags[i] & POST and parents[i] >= 0 and flags[parents[i]] & ARTICLE
        out[i] = bool(2 * linked[i] >= whole[i] or nested or (flags[i] & CLUTTER and clutter(i, slot[i], in_slots)))
    for i, up in enumerate(parents):
        out[i] |= up >= 0 and out[up]
    return out


def read_pages(pages: DataFrame) -> DataFrame:
    """Skeletons and token sequences of all pages that hold any, with the distinct tokens and their counts."""
    schema = pa.schema(
        [("host", pa.string()), *((name, pa.int64()) for name in ("fine", "coarse"))]
        + [(name, pa.list_(pa.int64())) for name in ("tokens", "parents", "lengths", "flags", "texts", "kinds", "counts")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, html in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                page = parse(html)
                rows = tokens_of(page)
                if rows:
                    counts = Counter(row[0] for row in rows)
                    head = [name, *skeleton(page)]
                    out.append([*head, *map(list, zip(*rows, strict=True)), list(counts), list(counts.values())])
            columns = zip(*out, strict=True) if out else ([] for _ in schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, f.type) for column, f in zip(columns, schema, strict=True)], schema=schema
            )

    rows = pages.filter("html <> ''").select(host().alias("host"), "html")
    return rows.mapInArrow(
        run,
        "host string, fine long, coarse long, tokens array<long>, parents array<long>, lengths array<long>, "
        "flags array<long>, texts array<long>, kinds array<long>, counts array<long>",
    )


def layouts(found: DataFrame) -> DataFrame:
    """Per host and fine skeleton, the layouts that its pages count for, and which one of them is its own."""
    different = found.select("host", "fine", "coarse", "same").distinct()
    kinds = stage(different.groupBy("host", "fine", "coarse").agg(F.count("*").alias("n")), "page-kinds")
    alike = kinds.groupBy("host", "coarse").agg(F.sum("n").alias("n_alike"), F.min("n").alias("least"))
    level = F.when(F.col("n") >= LAYOUT_PAGES, 0).when(F.col("n_alike") >= LAYOUT_PAGES, 1).otherwise(2)
    placed = kinds.join(alike, ["host", "coarse"]).withColumn("level", level)
    # Skeletons of few pages take the pages around them along.
    wide = placed.groupBy("host").agg(F.max("level").alias("widest"))
    held = F.array(
        F.when(F.col("level") == 0, F.struct(F.lit(0).alias("of"), F.xxhash64(F.lit(0), "fine").alias("layout"))),
        F.when(
            (F.col("least") < LAYOUT_PAGES) & (F.col("n_alike") >= LAYOUT_PAGES),
            F.struct(F.lit(1).alias("of"), F.xxhash64(F.lit(1), "coarse").alias("layout")),
        ),
        F.when(F.col("widest") == 2, F.struct(F.lit(2).alias("of"), F.lit(0).cast("long").alias("layout"))),
    )
    every = placed.join(wide, "host").select("host", "fine", "level", F.explode(F.array_compact(held)).alias("one"))
    return every.select("host", "fine", "one.layout", (F.col("one.of") == F.col("level")).alias("own"))


def number_pages(pages: DataFrame) -> DataFrame:
    """Pages as read, written, with a number and a digest of the sequence that copies share."""
    numbered = read_pages(pages).withColumn("same", F.xxhash64("tokens")).withColumn("row", F.monotonically_increasing_id())
    return stage(numbered, "page-tokens")


def sequences_in(found: DataFrame, placed: DataFrame) -> DataFrame:
    """Token sequences of different pages, one row for each layout that the page counts for."""
    first = stage(found.groupBy("host", "same").agg(F.min("row").alias("row")).select("row"), "page-different")
    return found.join(first, "row", "left_semi").join(placed, ["host", "fine"])


def page_tokens(pages: DataFrame) -> DataFrame:
    """Token sequences of different pages in their layouts."""
    found = number_pages(pages)
    return sequences_in(found, stage(layouts(found), "page-layouts"))


def equivalence_classes(sequences: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per layout of a host: its different pages, and the tokens of classes with enough support.

    A page has few tokens, so a layout has few that half of its pages share.
    """
    pages = sequences.groupBy("host", "layout").agg(F.count("*").alias("n_host"))
    pair = F.explode(F.arrays_zip("kinds", "counts")).alias("one")
    counted = sequences.select("host", "layout", "row", pair).select("host", "layout", "row", "one.*")
    # Two sums of 31-bit hashes of (page, count) stand for the vector.
    spread = [F.shiftrightunsigned(F.xxhash64("row", "counts", F.lit(k)), 33) for k in (1, 2)]
    vectors = counted.groupBy("host", "layout", F.col("kinds").alias("token")).agg(
        F.count("*").alias("n_pages"),
        F.sum("counts").alias("total"),
        *(F.sum(one).alias(f"sum{k}") for k, one in enumerate(spread)),
    )
    shared = vectors.join(stage(pages, "hosts"), ["host", "layout"])
    # What only one of several pages has is its own.
    shared = shared.filter(f"n_pages >= {support} * n_host AND n_pages >= least(n_host, {TEXT_PAGES})")
    root = (F.col("n_pages") == F.col("n_host")) & (F.col("total") == F.col("n_host"))
    number = F.xxhash64("n_pages", "total", "sum0", "sum1")
    token = F.struct("token", number.alias("class"), root.alias("root"))
    known = F.sort_array(F.collect_list(token)).alias("known")
    return shared.groupBy("host", "layout").agg(F.first("n_host").alias("n_host"), known)


def _observe(known: dict[int, tuple[int, bool]], row: dict) -> tuple[dict, dict, dict]:
    """Of one page: per class its order and gap, per template element its parent, text and heading, and the text
    in slots of elements that may go by their name, with the page's."""
    tokens, parents, texts, flags = row["tokens"], row["parents"], row["texts"], row["flags"]
    links = [n if f & LINK else 0 for n, f in zip(row["lengths"], flags, strict=True)]
    lengths = [n - linked for n, linked in zip(row["lengths"], links, strict=True)]
    slots = [0 if token in known else n for token, n in zip(tokens, lengths, strict=True)]
    names: dict[int, list[int]] = {}

    def clutter(i: int, mine: int, total: int) -> bool:
        if tokens[i] not in known:
            return False
        sums = names.setdefault(tokens[i], [0, 0])
        sums[0] += mine
        sums[1] += total
        return mine <= LITTLE * total

    out = settle(parents, flags, row["lengths"], links, slots, clutter)
    runs: dict[int, list[int]] = {}
    gaps: dict[int, set[int]] = {}
    seen_roots = 0
    for token in tokens:
        if token in known:
            number, root = known[token]
            runs.setdefault(number, []).append(token)
            gaps.setdefault(number, set()).add(seen_roots)
            seen_roots += root
    classes = {}
    for number, run in runs.items():
        # The order is one pass through the class, repeated.
        kinds = list(dict.fromkeys(run))
        regular = run == kinds * (len(run) // len(kinds))
        order = crc32(repr(kinds).encode()) if regular else -1
        root = known[run[0]][1]
        gap = 0 if root else gaps[number].pop() if len(gaps[number]) == 1 else -1
        classes[number] = (order, gap)
    elements: dict[int, list[int]] = {}
    for i, (token, parent, text) in enumerate(zip(tokens, parents, texts, strict=True)):
        if not text and token in known and known[token][1]:
            up = parent
            while up >= 0 and not (tokens[up] in known and known[tokens[up]][1]):
                up = parents[up]
            elements[token] = [tokens[up] if up >= 0 else 0, flags[i] | (OUTSIDE if out[i] else 0), 0, 0]
        if text and token not in known and not out[i] and not flags[i] & HEADER:
            heading = lengths[i] if flags[i] & HEADING else 0
            up = parent
            while up >= 0:
                if tokens[up] in elements:
                    elements[tokens[up]][2] += lengths[i]
                    elements[tokens[up]][3] += heading
                up = parents[up]
    return classes, elements, names


def _choose(elements: pd.DataFrame) -> int:
    """The container among a layout's template elements; 0 if there is none."""
    inside = elements[(elements["flags"].astype(int) & OUTSIDE) == 0]
    for flag in (ARTICLE, MAIN):
        marked = inside[(inside["flags"].astype(int) & flag) != 0]
        # The outermost: its parent does not carry the mark.
        outer = marked[~marked["up"].isin(set(marked["key"]))]
        if len(outer):
            # Of several, the one that is most of their text; else each page's own are read.
            best = outer.sort_values(["mass", "key"]).iloc[-1]
            alone = len(outer) == 1 or best["mass"] >= MASS * outer["mass"].sum() > 0
            return int(best["key"]) if alone else 0
    at, mass, heading = 0, inside["mass"].max() if len(inside) else 0, 0
    while mass:
        below = inside[(inside["up"] == at) & (inside["mass"] >= MASS * mass) & (2 * inside["heading"] >= heading)]
        if not len(below):
            break
        best = below.sort_values(["mass", "key"]).iloc[-1]
        at, mass, heading = int(best["key"]), best["mass"], best["heading"]
    return at


def deduce_templates(sequences: DataFrame, classes: DataFrame) -> DataFrame:
    """Per layout: the container's token, the tokens of valid classes, and those of elements that go by their name."""

    def observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "layout", "key", "kind", "low", "high", "gap_low", "gap_high", "up", "flags", "mass", "heading"]
        schema = pa.schema([(n, pa.string() if n == "host" else pa.int64()) for n in names])
        for batch in batches:
            out: dict[tuple, list] = {}
            for row in batch.to_pylist():
                known = {x["token"]: (x["class"], x["root"]) for x in row["known"]}
                at = row["host"], row["layout"]
                found, elements, named = _observe(known, row)
                for number, (order, gap) in found.items():
                    old = out.setdefault((*at, number, 1), [order, order, gap, gap, 0, 0, 0, 0])
                    old[:4] = [min(old[0], order), max(old[1], order), min(old[2], gap), max(old[3], gap)]
                for token, (up, flags, mass, heading) in elements.items():
                    old = out.setdefault((*at, token, 0), [0, 0, 0, 0, up, flags, 0, 0])
                    old[5] &= flags
                    old[6] += mass
                    old[7] += heading
                for token, (mine, total) in named.items():
                    old = out.setdefault((*at, token, 2), [0] * 8)
                    old[6] += mine
                    old[7] += total
            rows = [[*key, *values] for key, values in out.items()]
            columns = zip(*rows, strict=True) if rows else ([] for _ in names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, f.type) for column, f in zip(columns, schema, strict=True)], schema=schema
            )

    columns = ["host", "layout", "tokens", "parents", "lengths", "flags", "texts", "known"]
    seen = sequences.join(classes, ["host", "layout"]).select(*columns).mapInArrow(
        observe,
        "host string, layout long, key long, kind long, low long, high long, gap_low long, gap_high long, up long, "
        "flags long, mass long, heading long",
    )
    summed = seen.groupBy("host", "layout", "key", "kind").agg(
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("gap_low").alias("gap_low"),
        F.max("gap_high").alias("gap_high"),
        F.min("up").alias("up"),
        F.bit_and("flags").alias("flags"),
        F.sum("mass").alias("mass"),
        F.sum("heading").alias("heading"),
    )

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        found = rows[rows["kind"] == 1]
        valid = (found["low"] == found["high"]) & (found["low"] >= 0)
        valid &= (found["gap_low"] == found["gap_high"]) & (found["gap_low"] >= 0)
        at = _choose(rows[rows["kind"] == 0])
        named = rows[rows["kind"] == 2]
        named = named["key"][named["mass"] <= LITTLE * named["heading"]].tolist()
        valid = found["key"][valid].tolist()
        key = {name: [rows[name].iloc[0]] for name in ("host", "layout")}
        return pd.DataFrame(key | {"container": [at], "valid": [valid], "named": [named]})

    chosen = summed.groupBy("host", "layout").applyInPandas(
        choose, "host string, layout long, container long, valid array<long>, named array<long>"
    )
    held = F.filter("known", lambda x: F.array_contains("valid", x["class"]))
    texts = F.transform(held, lambda x: x["token"])
    enough = F.col("n_host") >= TEXT_PAGES
    return chosen.join(classes, ["host", "layout"]).select(
        "host",
        "layout",
        "container",
        F.when(enough, texts).otherwise(F.array().cast("array<long>")).alias("template"),
        F.when(enough, F.col("named")).alias("named"),
    )


def _outside(page: Page, template: set[int], named: set[int] | None) -> list[bool]:
    """Which elements of a page are other matter; without a template, the page alone tells what is little text."""
    elements = page.elements
    if not any(e.flags & NAMED for e in elements):
        return [bool(e.flags & OUTSIDE) for e in elements]
    lengths, links, slots = ([0] * len(elements) for _ in range(3))
    for text in page.texts:
        n = len(text.text) if text.text.strip() else 0
        up = elements[text.parent]
        lengths[text.parent] += n
        if up.flags & LINK:
            links[text.parent] += n
        elif text_token(up.token, text.text) not in template:
            slots[text.parent] += n

    def clutter(i: int, mine: int, total: int) -> bool:
        return mine <= LITTLE * total if named is None else elements[i].token in named

    return settle([e.parent for e in elements], [e.flags for e in elements], lengths, links, slots, clutter)


def main_text(page: Page, container: int, template: set[int], other: set[int] | None = None) -> str:
    """The text in the page's container, without what is not the article's.

    ``other`` are the elements that go by their name, as far as there is a template to tell.
    """
    elements = page.elements
    out = _outside(page, template, other)
    roots = {i for i, e in enumerate(elements) if container and e.token == container}
    named = bool(roots) and all(elements[i].flags & (ARTICLE | MAIN) for i in roots)
    if not roots:
        for flag in (ARTICLE, MAIN):
            marked = [i for i, e in enumerate(elements) if e.flags & flag and not out[i]]
            roots = {i for i in marked if not elements[elements[i].parent].flags & flag}
            if roots:
                named = True
                break
    found = bool(roots)
    if not roots:
        roots = {i for i, e in enumerate(elements) if e.tag == "body"} or {0}
    state: list[int] = []  # per element: 0 outside of the container, 1 article, 2 other matter
    for i, e in enumerate(elements):
        up = state[e.parent] if e.parent >= 0 else 0
        if i in roots:
            state.append(up or 1)
        elif up != 1:
            state.append(up)
        else:
            # Flags are inherited: what the container itself carries says nothing about its parts.
            new = e.flags & ~elements[e.parent].flags
            gone = (out[i] and not out[e.parent]) or (new & HEADER and not named)
            state.append(2 if gone else 1)
    kept = [t for t in page.texts if state[t.parent] == 1]
    if template:
        # A sentence stays whole if any of its runs is the page's own.
        own = {t.block for t in kept if t.text.strip() and text_token(elements[t.parent].token, t.text) not in template}
        left = [t for t in kept if t.block in own]
        n_left, n_kept = (sum(len(t.text.strip()) for t in some) for some in (left, kept))
        if not found or n_kept - n_left <= REPEATED * n_kept:
            kept = left
    return join_blocks(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    found = number_pages(pages)
    placed = stage(layouts(found), "page-layouts")
    sequences = sequences_in(found, placed)
    classes = stage(equivalence_classes(sequences), "page-classes")
    templates = stage(deduce_templates(sequences, classes), "page-templates")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[tuple, tuple] = {}
        for batch in batches:
            names = batch.schema.names
            page_id, url, html, name, layout, at, template, named = (batch.column(names.index(n)) for n in COLUMNS)
            texts = []
            for i in range(batch.num_rows):
                key = name[i].as_py(), layout[i].as_py()
                if key not in sets:
                    if len(sets) >= 1000:
                        sets.clear()
                    other = named[i].as_py()
                    sets[key] = set(template[i].as_py() or ()), None if other is None else set(other)
                source = html[i].as_py()
                texts.append(main_text(parse(source), at[i].as_py() or 0, *sets[key]) if source else "")
            yield pa.RecordBatch.from_arrays(
                [page_id, url.cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                schema=schema,
            )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(2).to_pylist()
            fine = pa.array([skeleton(parse(source))[0] if source else 0 for source in html], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, fine], [*batch.schema.names, "fine"])

    # Pages are parsed again instead of joined with what was read of them, so that none is shuffled.
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html", host().alias("host")
    ).mapInArrow(look, "page_id long, url string, html string, host string, fine long")
    own = placed.filter("own").select("host", "fine", "layout")
    joined = rows.join(own, ["host", "fine"], "left").join(templates, ["host", "layout"], "left")
    return joined.select(*COLUMNS).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )


COLUMNS = ["page_id", "url", "html", "host", "layout", "container", "template", "named"]
