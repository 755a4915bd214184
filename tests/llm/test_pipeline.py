import hashlib
import re

import public_tokenizers
import tiktoken
from test_mixing import brute as brute_mix
from test_mixing import n_words

import corpus_pipeline
from custodia.llm import byte_bpe, exact_dedup, mixing, near_dedup, quality_filter
from custodia.llm.common import read_table

SMALL = "/root/testdata/sf0.001"


def test_stages(spark, documents, labels):
    """Each stage does what its operator says, on all the stage before it kept."""
    docs = read_table(spark, SMALL, "documents")
    model = quality_filter.train(docs, labels)
    good = {r.doc_id for r in quality_filter.assess_documents(docs, model).filter("kept").collect()}
    step = dict(corpus_pipeline.STAGES)
    kept = step["quality_rules"](spark, docs, SMALL)
    assert {r.doc_id for r in kept.collect()} == good
    assert kept.columns == docs.columns

    unique = step["exact_dedup"](spark, kept, SMALL)
    first = {r.doc_id for r in exact_dedup.duplicates(kept).filter("kept").collect()}
    assert sorted(r.doc_id for r in unique.collect()) == sorted(first)
    assert unique.columns == docs.columns

    apart = step["near_dedup"](spark, unique, SMALL)
    lowest = {r.doc_id for r in near_dedup.near_duplicates(unique, 5).filter("kept").collect()}
    assert sorted(r.doc_id for r in apart.collect()) == sorted(lowest)

    mixed = step["mixing"](spark, apart, SMALL)
    times = {r.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mix(apart).collect()}
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {k: n for k, n in times.items() if n}

    found = corpus_pipeline.run(spark, SMALL).collect()
    want = byte_bpe.encode_documents(mixed, corpus_pipeline.RANKS).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want))


def test_empty(spark, no_docs, labels):
    docs = no_docs.select("doc_id", "text", "lang", "source")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SMALL)
    assert docs.count() == 0


def plain_pipeline(rows, model, peer):
    """The stages in plain Python over (doc_id, text, source) rows."""
    good = [row for row in rows if quality_filter.assess([(row[1] or "").encode()], model)["kept"][0]]

    groups = {}
    for row in good:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", row[1] or ""), []).append(row)
    unique = []
    for group in groups.values():
        first = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        unique += [row for row in group if row[0] is None or row == first]
    unique = list(dict.fromkeys(row for row in unique if row[0] is not None)) + [r for r in unique if r[0] is None]

    sets = [near_dedup.shingle_set((text or "").encode(), 5) for _, text, _ in unique]
    root = list(range(len(unique)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(unique)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]) or unique[i][:2] == unique[j][:2]:
                root[find(i)] = find(j)
    components = {}
    for i, row in enumerate(unique):
        components.setdefault(find(i), []).append(row)
    apart = [min(group, key=lambda r: (r[0] is None, r[0] or 0)) for group in components.values()]

    taken = {}
    for doc_id, size, source_size, _, words in brute_mix(apart):
        taken[(doc_id, size, source_size)] = words
    sizes = {}
    for _, text, source in apart:
        sizes[source] = sizes.get(source, 0) + n_words(text)
    out = []
    for doc_id, text, source in apart:
        size = n_words(text)
        times = int(taken[(doc_id, size, sizes[source])] / size + 0.5) if size else 0
        ids = peer.encode_ordinary(text or "")
        digests = (hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode()))
        out += [(doc_id, len(ids), *digests)] * times
    return sorted(out, key=str)


def test_edge_rows_through_all_stages(spark, documents, labels, tmp_path):
    """Nulls, repeated and missing ids, copies, near copies, and columns with names that stages use."""
    rows = [(int(r.doc_id), r.text, r.source) for r in documents.itertuples()]
    clean = [text for _, text, _ in rows if len(text.split()) > 120][:12]
    near = [" ".join([*text.split()[:-1], f"end{i}"]) for i, text in enumerate(clean)]
    rows += [
        (9001, clean[0], "src1"),
        (9002, f"  {clean[1]}\n", None),
        (9003, near[2], "src1"),
        (9004, f"{near[3]} and on", None),
        (9005, near[4], "src2"),
        (9005, " ".join(reversed(clean[5].split())), "src2"),
        (9006, near[6], "src3"),
        (9006, near[6], "src3"),
        (None, near[7], "src1"),
        (None, " ".join(reversed(clean[8].split())), None),
        (9007, None, None),
        (9008, "", "src1"),
        (9009, " \t\n", "src1"),
        (9010, " ".join(f"word{i % 3001}" for i in range(30_000)), "src1"),
        (None, None, None),
    ]
    schema = "doc_id long, text string, source string, lang string, node string, row int, component int, taken int, kept int"
    docs = spark.createDataFrame([(*row, None, "n", 1, 2, 3, 4) for row in rows], schema)
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    model = quality_filter.train(read_table(spark, str(tmp_path), "documents"), labels)
    ranks = {token: i for i, token in enumerate(byte_bpe.read_ranks(corpus_pipeline.RANKS))}
    peer = tiktoken.Encoding("peer", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = plain_pipeline(rows, model, peer)
    assert len({row[0] for row in want}) > 50
    found = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str)
    assert found == want
