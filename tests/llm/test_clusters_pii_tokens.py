"""Centroid clustering, personal data and tokenizer alignment against plain versions."""

import hashlib
import math
import os
import random
import re

import numpy as np
import pytest

from statloom.llm import alignment, clustering, pii
from tests_llm_rows import CLASH, odd_documents, words

# --- centroid clustering -----------------------------------------------------------


def plain_kmeans(rows, k, rounds, width, scale=64):
    """(id, cluster, distance) of every kept vector, and the centroids, by Lloyd's own loop."""
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        told = [near(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), c in zip(kept, told) if c == j]
            if mine:
                centroids[j] = tuple(sum(xs) // len(mine) for xs in zip(*mine))
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], centroids


def odd_vectors(width, n=150):
    r = random.Random(3)
    grid = lambda: [r.choice([-1.5, -0.5, 0.0, 0.25, 1.0]) for _ in range(width)]
    rows = [(i, grid()) for i in range(n)]
    rows += [(i, rows[5][1]) for i in range(200, 215)]  # copies
    rows += [(7, rows[7][1]), (7, grid()), (None, grid()), (None, grid())]  # repeated and null ids
    rows += [(300, None), (301, []), (302, [1.0] * (width + 1)), (303, [None] + [0.0] * (width - 1)),
             (304, [float("nan")] + [0.0] * (width - 1)), (305, [float("inf")] * width), (306, [0.0] * width)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    columns = ", ".join(f"{c} string" for c in ("id", "v", "near", "cluster", "distance"))
    rows = [(i, v, *["x"] * 5) for i, v in odd_vectors(4)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<float>, {columns}").repartition(4)


@pytest.mark.parametrize("k, rounds", [(16, 3), (5, 6), (1, 2), (500, 1), (16, 0)])
def test_clusters_equal_the_plain_loop(vectors, k, rounds):
    expected, centroids = plain_kmeans(odd_vectors(4), k, rounds, 4)
    found = clustering.cluster_vectors(vectors, k=k, rounds=rounds, dimensions=4)
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert order(map(tuple, found.rows.collect())) == order(expected)
    table = {r["cluster"]: r for r in found.clusters.collect()}
    assert [tuple(table[j]["centroid"]) for j in range(len(centroids))] == centroids
    for j, r in table.items():
        mine = [d for _, c, d in expected if c == j]
        assert (r["n"], r["cluster_inertia"], r["inertia"]) == (len(mine), sum(mine), sum(d for *_, d in expected))


def test_bounds_never_hide_a_nearer_centroid():
    r = np.random.default_rng(5)
    x = r.integers(-60, 60, (3_000, 8)) * r.integers(1, 3, (3_000, 1))
    centroids, before = x[:40].copy(), None
    near, second = np.zeros(len(x), np.int32), np.ones(len(x), np.int32)
    upper, lower = np.full(len(x), np.inf), np.full(len(x), -np.inf)
    searched = []
    for _ in range(12):
        n, _ = clustering.assign(x, near, second, upper, lower, clustering.geometry(centroids, before))
        searched.append(n)
        exact = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (near == exact.argmin(axis=1)).all()  # argmin takes the first, the smaller number
        before = centroids
        centroids = np.array([x[near == j].sum(axis=0) // max(1, (near == j).sum()) for j in range(40)])
    assert searched[-1] < searched[0] / 2


def test_clusters_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    found = clustering.cluster_vectors(none)
    assert found.rows.count() == 0 and found.clusters.count() == 0


def test_a_distance_beyond_a_long_is_an_error(spark):
    rows = spark.createDataFrame([(1, [1e30] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="no exact distance"):
        clustering.cluster_vectors(rows, dimensions=4)


# --- personal data -----------------------------------------------------------------

SPACES = re.compile(r"[\x20\x09-\x0D]+")
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_valid(kind, word):
    digits = re.sub("[^0-9]", "", word)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in word.split(".")),
            "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def matches(pattern, text):
    """Matches with what stands before and behind them, up to the next match."""
    found = list(re.finditer(pattern, text))
    for i, m in enumerate(found):
        low = found[i - 1].end() if i else 0
        high = found[i + 1].start() if i + 1 < len(found) else len(text)
        yield m, text[low:m.start()][-64:], text[m.end():high][:64]


def plain_base(text):
    return [(k, m.start(), m.end()) for k, name in enumerate(pii.KINDS)
            for m, _, _ in matches(PLAIN[name], text or "") if plain_valid(name, m.group())]


def plain_contexts(left, right):
    def split(t):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        return [w for w in (x.strip(pii.MARKS) for x in SPACES.split(re.sub("[0-9]", "0", lowered))) if w]

    before, after = ["^", "^", *split(left)][-2:], [*split(right), "$", "$"][:2]
    made = [f"L {before[0]} {before[1]}", f"B {before[1]} _ {after[0]}", f"R {after[0]} {after[1]}"]
    return [p for p in made if p not in ("L ^ ^", "B ^ _ $", "R $ $")]


def plain_pii(texts, min_support, min_confidence, trust, rounds):
    """Spans that the contexts add, per text, by the rules of the docstring."""
    edges, kind_of, mask_of, places = {}, {}, {}, []
    for at, text in enumerate(texts):
        text = text or ""
        for k, name in enumerate(pii.KINDS):
            for m, left, right in matches(PLAIN[name], text):
                if plain_valid(name, m.group()):
                    kind_of[m.group()] = min(k, kind_of.get(m.group(), k))
                    for p in plain_contexts(left, right):
                        edges.setdefault(p, set()).add(m.group())
        for m, left, right in matches(pii.IDENTIFIER, text):
            word = m.group()
            if any(plain_valid(k, x.group()) for k in pii.KINDS for x in re.finditer(PLAIN[k], word)):
                continue
            core = word.strip(pii.MARKS)
            if not core:
                continue
            mask_of[core] = [k for k, name in enumerate(pii.KINDS) if re.search(pii.LOOSE[name], core)]
            start = m.start() + len(word) - len(word.lstrip(pii.MARKS))
            places.append((at, core, start, start + len(core)))
            for p in plain_contexts(left, right):
                edges.setdefault(p, set()).add(core)
    told = {i: (k, 1.0) for i, k in kind_of.items()}
    found = {}
    for _ in range(rounds):
        accepted = {}
        for p, members in edges.items():
            for k in range(4):
                mine = [told[i][1] for i in members if i in told and told[i][0] == k]
                against = [i for i in members if (told[i][0] != k if i in told else k not in mask_of[i])]
                confidence = sum(mine) / (len(mine) + len(against) + pii.PRIOR)
                if len(mine) >= min_support and confidence >= min_confidence:
                    accepted[p] = max(accepted.get(p, (0, 0)), (confidence, -k))
        odds = {}
        for p, (confidence, k) in accepted.items():
            for i in edges[p]:
                if i not in kind_of and -k in mask_of[i]:
                    odds[i, -k] = odds.get((i, -k), 1.0) * (1 - confidence)
        best = {}
        for (i, k), o in odds.items():
            best[i] = max(best.get(i, (0, 0)), (round(1 - o, 9), -k))
        found = {i: -k for i, (b, k) in best.items() if b >= trust}
        told = {i: (k, 1.0) for i, k in kind_of.items()} | {i: (k, best[i][0]) for i, k in found.items()}
    spans = [[] for _ in texts]
    for at, core, start, stop in places:
        if core in found and not any(s < stop and start < e for _, s, e in plain_base(texts[at])):
            spans[at].append((found[core], start, stop))
    return [sorted(set(s)) for s in spans]


def person_texts():
    r = random.Random(9)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card():
        head = number(15)
        return next(head + d for d in "0123456789" if luhn(head + d))

    def phone():
        return f"+1 ({number(3)}) {number(3)}-{number(4)}"

    texts = [f"{words(i, 8)} My Card Number: {card()}, thank you. {words(i + 1, 5)}" for i in range(14)]
    texts += [f"{words(i, 6)} call me at {phone()} tonight or mail {words(i, 1)}.{i}@mail{i}.example.com soon"
              for i in range(30, 44)]
    wrong = next(x for x in (number(16) for _ in range(99)) if not luhn(x))
    texts += [
        f"é😀 my card number {wrong} thank you",  # fails its check sum, told by its context
        "please call me at 555 123 9876 tonight or",  # no plus
        f"see {wrong} there, and {wrong[::-1]} elsewhere",  # the first is known by now
        "or mail someone@localhost soon today",
        "my card number 12 thank you",  # too short for a card
        "my card number: my card number:",
        "10.0.0.1 10.0.0.256 1.2.3.4.5.6.7.8 00255.1.1.1 a@b.c_d@e.f x@y +1 23 (45) 67-89 + 12345678901",
        "4111 1111-1111 1111 4111111111111111 0000000000000 99", None, "", "no digits at all",
        "9" * 3_000, "a" * 3_000, "a@" * 1_000, "1.2.3.4." * 700, "x@" + "b." * 2_000 + "c",
        " ".join(f"{i}.1.1.1" for i in range(700)), "+1" + " " * 5_000, "1-" * 3_000]
    return texts + [t for _, t, *_ in odd_documents()]


OPTIONS = {"min_support": 5, "min_confidence": 0.8, "trust": 0.8, "rounds": 3}


def test_pii_equals_the_plain_version(spark):
    texts = person_texts()
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in ("base", "found", "known", "open", *CLASH))
    rows = [(i if i % 7 else None, t, *["x"] * (4 + len(CLASH))) for i, t in enumerate(texts)]
    found = pii.find_pii(spark.createDataFrame([*rows, rows[0]], schema).repartition(6), **OPTIONS)
    spans = lambda s: tuple((x["kind"], x["start"], x["stop"]) for x in s)
    got = sorted((str(r["doc_id"]), spans(r["base"]), spans(r["found"])) for r in found.rows.collect())
    added = plain_pii([*texts, texts[0]], **OPTIONS)
    expected = sorted((str(r[0]), tuple(plain_base(r[1])), tuple(a)) for r, a in zip([*rows, rows[0]], added))
    assert got == expected
    revealed = {(texts[i][s:e], pii.KINDS[k]) for i, row in enumerate(added[:-1]) for k, s, e in row}
    assert {k for _, k in revealed} == {"card", "phone", "email"}
    assert ("555 123 9876", "phone") in revealed and ("someone@localhost", "email") in revealed
    assert {r["kind"] for r in found.patterns.collect()} >= {"card", "phone", "email"}


def test_pii_in_texts_that_break_patterns(spark):
    """Long runs neither overflow the stack nor take time with the square of their length."""
    texts = ["9" * 400_000, "a" * 1_000_000, "a@" * 200_000, "x@" + "b." * 200_000 + "c", "+1" + " " * 500_000,
             "1-" * 300_000, "1.2.3.4 " * 50_000]
    found = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).rows
    base = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in found.collect()}
    ends = [(1, 8 * i, 8 * i + 7) for i in range(50_000)]
    assert base == {0: [], 1: [], 2: [], 3: [(0, 0, len(texts[3]))], 4: [], 5: [], 6: ends}


def test_pii_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    found = pii.find_pii(none)
    assert (found.rows.count(), found.patterns.count(), found.instances.count()) == (0, 0, 0)


# --- tokenizer alignment -----------------------------------------------------------

needs_files = pytest.mark.skipif(not os.path.isdir(alignment.FOLDER), reason="tokenizer files not present")


def dense(m, width):
    out = np.zeros((len(m.indptr) - 1, width), np.int64)
    for r in range(len(out)):
        for at in range(m.indptr[r], m.indptr[r + 1]):
            out[r, m.indices[at]] += m.values[at]
    return out


def test_sparse_products_equal_dense_ones():
    r = np.random.default_rng(2)
    for _ in range(60):
        n, k, m = r.integers(0, 7, 3)
        left, right = r.integers(0, 3, (n, k)), r.integers(0, 2, (k, m))
        csr = lambda d: alignment.Csr(
            np.concatenate([[0], np.cumsum((d > 0).sum(axis=1))]).astype(int), np.nonzero(d)[1], d[d > 0])
        assert (dense(alignment.product(csr(left), csr(right)), m) == left @ right).all()
        assert (dense(alignment.transposed(csr(left), k), n) == left.T).all()


def plain_align(text, coders):
    """Tokens, groups and links of one text by loops over byte ranges."""
    raw = (" " + text).encode() if text else b""
    sides = []
    for c in coders:
        ids = c.encode([text])[0] if text else []
        if b"".join(c.pieces[i] for i in ids) != raw:
            return [], [], "", []
        at, spans = 0, []
        for i in ids:
            spans.append((at, at + len(c.pieces[i]), i))
            at += len(c.pieces[i])
        sides.append(spans)
    a, b = sides
    cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
    groups, low = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for s, e, i in side if low < e <= cut) for side in sides))
        low = cut
    links = [(i, j, min(e, f) - max(s, t)) for s, e, i in a for t, f, j in b if s < f and t < e]
    return a, b, ";".join(groups), links


@pytest.fixture(scope="module")
def coders():
    return (alignment.byte_level(os.path.join(alignment.FOLDER, alignment.BYTE_FILE)),
            alignment.sentence_pieces(os.path.join(alignment.FOLDER, alignment.PIECE_FILE)))


TEXTS = ["Hello world, naïve façade 你好 😀 x", "<|endoftext|> and </s> <s> <unk> <0x41> are text", "a▁b", "  two  spaces ",
         "tab\tand\nlines\r\n", "\x00\x01", "é ﬁ Ⅷ ½", None, "", " ", "a", "a" * 3_000, "the the the", "the the the"]


@needs_files
def test_the_rank_coder_gives_the_ids_of_the_file(coders):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(os.path.join(alignment.FOLDER, alignment.BYTE_FILE))
    own.encode_special_tokens = True
    signs = [f"a{chr(c)}1{chr(c)} {chr(c)}b{chr(c)}{chr(c)}. {chr(c)}" for c in range(0x20, 0x3000)]
    texts = [t for t in TEXTS if t] + signs + [words(3, 40_000), "x" * 120_000]
    expected = [e.ids for e in own.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert coders[0].encode(texts) == expected


@needs_files
@pytest.mark.parametrize("broadcast_bytes", [alignment.BROADCAST_BYTES, 0])
def test_alignment_equals_the_plain_version(spark, coders, broadcast_bytes):
    texts = [*TEXTS, *(t for _, t, *_ in odd_documents() if t is None or len(t) < 2_000)]
    clash = ", ".join(f"{c} string" for c in ("row", "pair", "times", "groups", "n_a", "a", "b", *CLASH))
    rows = [(i if i % 5 else None, t, *["x"] * (7 + len(CLASH))) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, {clash}").repartition(3)
    aligned = alignment.store(alignment.align_tokens(docs), "test-aligned")
    found = alignment.correspondence(aligned, broadcast_bytes)
    agreed = {r["row"]: (r["n_best"], r["count_sum"]) for r in found.rows.collect()}
    plain = [plain_align(t, coders) for t in texts]
    counts = {}
    for *_, links in plain:
        for i, j, _ in links:
            counts[i, j] = counts.get((i, j), 0) + 1
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(top.get(j, 0), n)
    expected = sorted((str(r[0]), len(a), len(b), groups, sorted(links), sum(counts[i, j] == top[j] for i, j, _ in links),
                       sum(counts[i, j] for i, j, _ in links)) for r, (a, b, groups, links) in zip(rows, plain))
    got = []
    for r in aligned.collect():
        links = sorted((r["a"][i], r["b"][j], o) for i, j, o in zip(r["link_a"], r["link_b"], r["overlap"]))
        assert len(links) == r["n_links"] and r["n_groups"] == (r["groups"].count(";") + 1 if r["groups"] else 0)
        got.append((str(r["doc_id"]), r["n_a"], r["n_b"], r["groups"], links, *agreed.get(r["row"], (0, 0))))
        shared = sum((np.array(r["group_a"]) == g).sum() * (np.array(r["group_b"]) == g).sum() for g in range(r["n_groups"]))
        assert shared == r["n_shared"]
    assert sorted(got) == expected
    assert {(p["a"], p["b"]): (p["links"], p["best"]) for p in found.pairs.collect()} == {
        (i, j): (n, n == top[j]) for (i, j), n in counts.items()}


@needs_files
def test_alignment_query_hashes_groups(spark, coders, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["groups_sha256"] for r in alignment.op11_cross_tokenizer_alignment(spark, str(tmp_path)).collect()}
    for i, t in rows:
        groups = plain_align(t, coders)[2]
        assert got[i] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


@needs_files
def test_alignment_of_nothing(spark):
    none = alignment.align_tokens(spark.createDataFrame([], "doc_id long, text string"))
    assert none.count() == 0 and alignment.correspondence(none).rows.count() == 0
