"""Exact, near and line deduplication against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from statloom.llm import exact_dedup, graph, line_dedup, simhash
from statloom.llm.common import attach_groups, keep_rows, without
from tests_llm_rows import odd_documents, words

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def test_golomb_codes_round_trip():
    rng = np.random.default_rng(0)
    for n, top in ((1, 10), (500, 600), (500, 2**63), (3, 2**64 - 1)):
        values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        k, code = exact_dedup.golomb_encode(values)
        assert (exact_dedup.golomb_decode(k, code, len(values)) == values).all()
    assert exact_dedup.golomb_encode(np.empty(0, np.uint64)) == (0, b"")


@pytest.mark.parametrize("owner_hashes", [400_000, 3])
def test_exact_groups(odd, owner_hashes):
    rows = odd_documents()
    norm = [SPACE.sub(" ", t or "") for _, t, _, _ in rows]
    groups = defaultdict(list)
    for (i, *_), t in zip(rows, norm, strict=True):
        groups[t].append(i)
    expected = Counter()
    for (i, *_), t in zip(rows, norm, strict=True):
        ids = [x for x in groups[t] if x is not None]
        expected[i, min(ids) if ids else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()] += 1
    got = exact_dedup.exact_dedup(odd, owner_hashes=owner_hashes).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == expected
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_groups_of_nothing(none):
    assert exact_dedup.exact_dedup(none).collect() == []


def test_kept_rows_stay_whole(odd, none):
    kept = keep_rows(odd, exact_dedup.exact_dedup(odd))
    assert kept.columns == odd.columns
    texts = [SPACE.sub(" ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({SPACE.sub(" ", t or "") for _, t, _, _ in odd_documents()})
    assert keep_rows(none, exact_dedup.exact_dedup(none)).count() == 0


def plain_fingerprint(text):
    w = [x for x in SPACE.split(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_are_the_plain_ones():
    for text in [*(t for _, t, _, _ in odd_documents() if not t or len(t) < 2000), words(9, 300), "A b", "É a B"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_near_classes(odd, none):
    rows = [(i, simhash.fingerprint(t)) for i, t, _, _ in odd_documents()]
    classes = plain_classes([f for _, f in rows])
    ids = defaultdict(list)
    for (i, _), c in zip(rows, classes, strict=True):
        ids[c].append(i)
    low = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    expected = Counter((i, f, low[c], len(ids[c])) for (i, f), c in zip(rows, classes, strict=True))
    got = simhash.near_dedup(odd).collect()
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id, r.group_size) for r in got) == expected
    assert sum(r.kept for r in got) == len(ids)
    assert simhash.near_dedup(none).collect() == []


def test_dense_fingerprints_without_all_pairs(spark, monkeypatch):
    """A cluster far above the bucket size still gets exactly its components."""
    monkeypatch.setattr(simhash, "BUCKET", 16)
    rng = np.random.default_rng(4)
    base = int(rng.integers(0, 2**63))
    prints = {base ^ int(x) for x in rng.integers(0, 2**10, 150)}
    prints |= {base ^ int(x) << 40 for x in rng.integers(0, 2**12, 100)}
    prints = sorted(prints)
    signed = [simhash._signed(p) for p in prints]
    # The link function runs in this process, so that the small bucket size holds there.
    import pandas as pd

    rows = pd.DataFrame([(simhash._signed(m), f) for m in simhash.child_masks(0) for f in signed],
                        columns=["mask", "fp"])
    links = []
    while len(rows):
        rows["key"] = rows["mask"] & rows["fp"]
        rows = rows.drop_duplicates().sort_values(["mask", "key"])
        out = pd.concat(list(simhash._link(iter([rows.iloc[:500], rows.iloc[500:]]))))
        assert (out["mask"] == 0).sum() <= len(rows)
        links += out[out["mask"] == 0][["a", "b"]].to_numpy().tolist()
        rows = out[out["mask"] != 0][["mask", "a"]].rename(columns={"a": "fp"})
    found = graph.components(spark.createDataFrame([tuple(x) for x in links], "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    expected = plain_classes([s % 2**64 for s in signed])
    pairs = {(expected[i], roots.get(s, s)) for i, s in enumerate(signed)}
    assert len(pairs) == len(set(expected)) == len({b for _, b in pairs})


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300))
    assert 5000 not in got and graph.components(spark.createDataFrame([], "x long, y long")).count() == 0


def plain_lines(rows, at_least=5):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, t, _, _ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = Counter()
    for i, t, _, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < at_least
                or i is not None and i == max(h for h in holders[key(x)] if h is not None)]
        out[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


def test_shared_lines(odd, none, spark):
    got = line_dedup.line_dedup(odd).collect()
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == plain_lines(odd_documents())
    assert line_dedup.line_dedup(none).collect() == []
    line = "this line has more than forty characters in it É"
    rows = [(i, f"{line}\nown {i}\n{line}  \n", "en", "s") for i in range(5)] + [(None, line, None, None)]
    rows += [(9, line.lower(), None, None)]  # the accented capital stays another letter
    table = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = line_dedup.line_dedup(table).collect()
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got) == plain_lines(rows)


def test_hot_groups_join_without_loss(spark):
    rows = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(3000)], "i long, k long")
    groups = rows.groupBy("k").count().withColumnRenamed("count", "n")
    got = attach_groups(rows, groups, ["k"], "n", 3000)
    assert got.filter("n is null").count() == 0 and got.filter("k = 1").agg({"n": "min"}).first()[0] == 2000
    assert got.count() == 3000


def test_without_treats_null_as_a_value(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "k long")
    assert [r.k for r in without(rows, spark.createDataFrame([(None,), (2,)], "k long")).collect()] == [1]
