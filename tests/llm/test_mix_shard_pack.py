"""Mixing, sharding and packing: totals, laws and brute force on awkward tables."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from statloom.llm import mixing, packing, sharding
from tests_llm_rows import odd_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sizes():
    return [len(WORD.findall(t or "")) for _, t, _, _ in odd_documents()]


def plain_targets(by_source):
    order = sorted(by_source, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(by_source.values()), set(order), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        capped = {s for s in open_ if 2 * by_source[s] <= level * weight[s]}
        if not capped:
            return target | {s: level * weight[s] for s in open_}
        for s in capped:
            target[s] = 2.0 * by_source[s]
            left -= target[s]
        open_ -= capped


@pytest.mark.parametrize("block", [7, 1024])
def test_mix_reaches_its_targets(odd, block):
    by_source = Counter()
    for (_, _, _, s), n in zip(odd_documents(), sizes(), strict=True):
        by_source[s] += n
    target = plain_targets(by_source)
    mix = mixing.mix_sources(odd, block=block)
    rows = mix.rows.collect()
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == Counter(
        (i, s, n) for (i, _, _, s), n in zip(odd_documents(), sizes(), strict=True))
    taken = Counter()
    for r in rows:
        assert abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(taken[s] == int(target[s] + 1e-9) for s in target)
    again = mixing.mix_sources(odd.repartition(2), block=block).rows.collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    # Slots: ranks of a source without gaps, pieces of a slot within a block and in one run.
    ranks = defaultdict(list)
    for r in mix.schedule.collect():
        ranks[r["src"]].append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in ranks.values())
    words = Counter()
    for r in mix.pieces.collect():
        words[r["at"]] += r["n_words"]
    assert max(words.values()) <= block and sum(words.values()) == sum(taken.values())


def test_schedule_is_even(spark):
    sources = spark.createDataFrame([(f"s{i}", n, float(n)) for i, n in enumerate((7000, 2000, 1000))],
                                    "source string, source_size long, target double")
    table = mixing._slots(sources, 10)
    slots = [r["src"] for r in mixing._schedule(table, 1000).orderBy("at").collect()]
    share = {1: 0.7, 2: 0.2, 3: 0.1}
    for n in range(50, 1000, 50):
        found = Counter(slots[:n])
        assert all(abs(found[s] - share[s] * n) < 8 for s in share)


def test_mix_as_documents(odd, none):
    mix = mixing.mix_sources(odd)
    taken = mixing.take(odd, mix)
    assert taken.columns == odd.columns
    got = Counter()
    for r in taken.collect():
        got[r.source] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    want = Counter()
    for r in mix.rows.collect():
        want[r.source] += r.taken
    assert got == +want
    assert mixing.mix_sources(none).rows.collect() == []
    assert mixing.take(none, mixing.mix_sources(none)).collect() == []


@pytest.mark.parametrize(("shards", "tolerance"), [(3, 0.0), (40, 0.0), (4, 0.3)])
def test_shards(odd, none, shards, tolerance):
    rows = sharding.shard_by_bytes(odd, shards, carry=(), tolerance=tolerance).collect()
    plain = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                    for i, t, _, _ in odd_documents())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == plain
    slots, held = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        held[r.shard] += r.size
    assert all(0 <= s < shards for s in slots)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    # Every cut is at most half a row and the tolerance away from its target.
    share, below = sum(held.values()) / shards, 0
    for s in range(shards - 1):
        below += held[s]
        off = max(n for _, n, _ in plain) / 2 + tolerance * share
        assert abs(below - share * (s + 1)) <= off
    assert sharding.shard_by_bytes(none).collect() == []


def test_shards_of_equal_rows_and_carried_columns(spark, odd):
    table = spark.createDataFrame([(1, "copy")] * 400, "doc_id long, text string").repartition(4)
    held = Counter(r.shard for r in sharding.shard_by_bytes(table, 8).collect())
    assert set(held.values()) == {50}
    columns = sharding.shard_by_bytes(odd, 4).columns
    assert set(odd.columns) <= set(columns) and len(columns) == len(set(columns))


def test_written_shards(odd, tmp_path, spark):
    sharding.write_shards(sharding.shard_by_bytes(odd, 4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(odd_documents())


def plain_best_fit(sizes, sources, clusters, capacity, limit):
    bins, placed = [], []
    for turn, (n, s, c) in enumerate(zip(sizes, sources, clusters, strict=True)):
        fits = [b for b in bins if b["left"] >= n and (c < 0 or c not in b["clusters"]) and b["from"].count(s) < limit]
        if fits:
            chosen = min(fits, key=lambda b: (b["left"], b["turn"]))
        else:
            chosen = {"left": capacity, "clusters": set(), "from": [], "no": len(bins)}
            bins.append(chosen)
        chosen["left"] -= n
        chosen["turn"] = turn
        chosen["from"].append(s)
        chosen["clusters"].add(c)
        placed.append(chosen["no"])
    return placed


def test_best_fit_is_the_tightest_compatible_bin():
    r = random.Random(2)
    for _ in range(150):
        n, capacity, limit = r.randint(0, 90), r.randint(5, 40), r.randint(1, 4)
        items = ([r.randint(1, capacity) for _ in range(n)], [r.randint(0, 3) for _ in range(n)],
                 [r.randint(-1, 8) for _ in range(n)])
        assert packing.best_fit(*items, capacity, limit) == plain_best_fit(*items, capacity, limit)


@pytest.mark.parametrize("group_rows", [10, 4096])
def test_packing(odd, none, group_rows):
    capacity, limit = 100, 3
    rows = packing.pack(odd, capacity, limit, group_rows=group_rows).collect()
    plain = Counter()
    for (i, _, _, s), n in zip(odd_documents(), sizes(), strict=True):
        for p in range(max(1, -(-n // capacity))):
            plain[i, s, p, p * capacity, min(capacity, n - p * capacity)] += 1
    assert Counter((r.doc_id, r.source, r.piece, r.first_word, r.n_words) for r in rows) == plain
    bins = defaultdict(list)
    for r in rows:
        assert (r.bin_id is None) == (r.n_words == 0)
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    text = {i: " ".join((t or "").split()).lower() for i, t, _, _ in odd_documents()}
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_words
        assert at == held[0].bin_words <= capacity
        assert max(Counter(r.source for r in held).values()) <= limit
        texts = [text[r.doc_id] for r in held if r.doc_id is not None]
        assert len(texts) == len(set(texts))
    assert packing.pack(none).collect() == []


def test_packing_fills_its_bins(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join([f"w{i}"] * int(n)), f"s{i % 5}") for i, n in enumerate(rng.integers(1, 60, 600))]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), 100).collect()
    used = len({r.bin_id for r in got}) * 100
    assert sum(r.n_words for r in got) / used > 0.95
