"""Alignment of two tokenizers on the same text by products of sparse incidence matrices."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import attach_groups, query, read, share_package, store

# The vocabulary files; on a cluster every executor finds them under the same path.
FOLDER = "/opt/tokenizers"
BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"
# Texts that one call of a tokenizer gets, by their characters.
BATCH_CHARS = 200_000
# Longer texts are not given to the rank coder.
RANK_CHARS = 100_000
# Fixed value: how byte-level BPE of this family cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A pair of ids (a, b) is the number a << ID_BITS | b.
ID_BITS = 20
# Pair counts are broadcast up to this many bytes, as measured, and met in a shuffle beyond.
BROADCAST_BYTES = 32 << 20
PAIR_BYTES = 48


# --- sparse matrices ---------------------------------------------------------------


class Csr(NamedTuple):
    """A sparse matrix by rows: row r holds the columns indices[indptr[r]:indptr[r + 1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray


def incidence(ends: np.ndarray) -> Csr:
    """Tokens x bytes: token r covers the bytes from the end of the one before to its own."""
    return Csr(np.concatenate([[0], ends]), np.arange(ends[-1] if len(ends) else 0),
               np.ones(int(ends[-1]) if len(ends) else 0, np.int64))


def transposed(m: Csr, columns: int) -> Csr:
    rows = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))
    order = np.argsort(m.indices, kind="stable")
    counts = np.bincount(m.indices, minlength=columns)
    return Csr(np.concatenate([[0], np.cumsum(counts)]), rows[order], m.values[order])


def product(left: Csr, right: Csr) -> Csr:
    """Gustavson's product: a row of the result gathers the rows of ``right`` that a row of ``left`` names."""
    width = np.diff(right.indptr)[left.indices]
    row = np.repeat(np.repeat(np.arange(len(left.indptr) - 1), np.diff(left.indptr)), width)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
    at = np.repeat(right.indptr[left.indices], width) + inside
    column, value = right.indices[at], np.repeat(left.values, width) * right.values[at]
    if len(row) and not ((row[1:] > row[:-1]) | ((row[1:] == row[:-1]) & (column[1:] >= column[:-1]))).all():
        order = np.lexsort((column, row))
        row, column, value = row[order], column[order], value[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
    starts = np.flatnonzero(fresh)
    sums = np.add.reduceat(value, starts) if len(starts) else value
    counts = np.bincount(row[starts], minlength=len(left.indptr) - 1)
    return Csr(np.concatenate([[0], np.cumsum(counts)]), column[starts], sums)


def row_numbers(m: Csr) -> np.ndarray:
    """The row of every entry."""
    return np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))


# --- tokens ------------------------------------------------------------------------


class Coder(NamedTuple):
    """encode: texts -> lists of ids; pieces: the bytes of every id."""

    encode: Callable[[list[str]], list[list[int]]]
    pieces: list[bytes]


def byte_level(path: str) -> Coder:
    """The byte-level BPE of a tokenizers file; every text gets a space in front.

    Where the file's merges stand in the order of their ids, a rank coder gives the same ids in
    a quarter of the time; texts beyond RANK_CHARS go to the file's own library, whose memory
    and stack do not depend on how a text is split.
    """
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    coder = Tokenizer.from_file(path)
    coder.encode_special_tokens = True
    # Printable Latin letters stand for their own byte, the others for the letters from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)})
    special = {i for i, t in coder.get_added_tokens_decoder().items() if t.special}
    pieces = []
    for i in range(coder.get_vocab_size()):
        piece = coder.id_to_token(i) or ""
        pieces.append(piece.encode() if i in special else bytes(letters[c] for c in piece))
    whole = lambda texts: [e.ids for e in coder.encode_batch(texts, add_special_tokens=False)]
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    made = ("".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"])
    if any(model["vocab"][m] != 256 + i for i, m in enumerate(made)):
        return Coder(lambda texts: whole([" " + t for t in texts]), pieces)
    ranks = {p: i for i, p in enumerate(pieces) if i not in special}
    quick = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        return [quick.encode_ordinary(" " + t) if len(t) <= RANK_CHARS else whole([" " + t])[0] for t in texts]

    return Coder(encode, pieces)


def sentence_pieces(path: str) -> Coder:
    """The BPE with byte fallback of a sentencepiece model, which puts the space in front itself."""
    import sentencepiece

    coder = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(coder.get_piece_size()):
        piece = coder.id_to_piece(i)
        pieces.append(bytes([int(piece[3:-1], 16)]) if coder.is_byte(i) else piece.replace("▁", " ").encode())
    return Coder(lambda texts: coder.encode(texts, num_threads=1), pieces)


# --- one text ----------------------------------------------------------------------


class Aligned(NamedTuple):
    """a, b: ids; links and shared: rows and columns of the two products; overlap: bytes that
    a link shares; group_a, group_b: the group of every token; n_groups."""

    a: np.ndarray
    b: np.ndarray
    links: tuple[np.ndarray, np.ndarray]
    overlap: np.ndarray
    shared: Csr
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int


def align(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> Aligned:
    """Links of two token sequences over the same bytes, given the bytes of every token.

    A Bᵀ of the token-byte matrices holds a link per pair of tokens with common bytes. The
    group-incidence matrices do the same for the groups between common ends.
    """
    ends_a, ends_b = np.cumsum(size_a), np.cumsum(size_b)
    links = product(incidence(ends_a), transposed(incidence(ends_b), int(ends_b[-1]) if len(b) else 0))
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    one = lambda g: Csr(np.arange(len(g) + 1), g, np.ones(len(g), np.int64))
    shared = product(one(group_a), transposed(one(group_b), len(common)))
    return Aligned(a, b, (row_numbers(links), links.indices), links.values, shared, group_a, group_b, len(common))


class Writer:
    """Texts of groups, a1,a2|b1;a3|b2: every token is its number with the mark that follows it."""

    def __init__(self, many_a: int, many_b: int):
        self.words = [f"{i}{mark}" for many, marks in ((many_a, ",|"), (many_b, ",;")) for mark in marks for i in range(many)]
        self.starts = (0, many_a, 2 * many_a, 2 * many_a + many_b)

    def text(self, t: Aligned) -> str:
        out = np.empty(len(t.a) + len(t.b), np.int64)
        for ids, group, other, side, base in ((t.a, t.group_a, t.group_b, "left", 0), (t.b, t.group_b, t.group_a, "right", 2)):
            # Tokens of the other side that stand before this one.
            before = np.searchsorted(other, group, side=side)
            last = np.append(group[1:] != group[:-1], True)
            out[np.arange(len(ids)) + before] = ids + np.where(last, self.starts[base + 1], self.starts[base])
        return "".join(map(self.words.__getitem__, out.tolist()))[:-1]


# --- documents ---------------------------------------------------------------------


def _batches(texts: list[str]) -> Iterator[list[int]]:
    """Places of texts, so many characters at a time; one longer text comes alone."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if held and size + len(t) > BATCH_CHARS:
            yield held
            held, size = [], 0
        held.append(i)
        size += len(t)
    if held:
        yield held


def _aligner(folder: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = byte_level(os.path.join(folder, BYTE_FILE)), sentence_pieces(os.path.join(folder, PIECE_FILE))
        sizes = [np.array([len(p) for p in c.pieces]) for c in coders]
        writer = Writer(*(len(c.pieces) for c in coders))
        # The table is stored, so a repeated task numbers its rows the same way.
        row = TaskContext.get().partitionId() << 33
        empty = np.empty(0, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = batch.column("id")
            for places in _batches(texts):
                chosen = [texts[i] for i in places]
                coded = [[np.array(x, np.int64) for x in c.encode(chosen)] for c in coders]
                rows = []
                for text, a, b in zip(chosen, *coded):
                    raw = (" " + text).encode()
                    same = text and all(b"".join(map(c.pieces.__getitem__, x.tolist())) == raw for c, x in zip(coders, (a, b)))
                    t = align(a, b, sizes[0][a], sizes[1][b]) if same else align(empty, empty, empty, empty)
                    r, c = t.links
                    pair, times = np.unique(t.a[r] << ID_BITS | t.b[c], return_counts=True)
                    groups = writer.text(t) if same else ""
                    record = {"row": row, "n_a": len(t.a), "n_b": len(t.b), "n_groups": t.n_groups, "n_links": len(r),
                              "n_shared": len(t.shared.indices),
                              "groups": groups if full else hashlib.sha256(groups.encode()).hexdigest() if same else "",
                              "pair": pair, "times": times}
                    if full:
                        record |= {"a": t.a, "b": t.b, "link_a": r, "link_b": c, "overlap": t.overlap,
                                   "group_a": t.group_a, "group_b": t.group_b}
                    rows.append(record)
                    row += 1
                names = list(rows[0])
                columns = [pa.array([x[n] for x in rows], KIND[n]) for n in names]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(places)), *columns], names=["id", *names])

    return run


_LONGS = ("a", "b", "link_a", "link_b", "overlap", "group_a", "group_b", "pair", "times")
KIND = {**{n: pa.int64() for n in ("row", "n_a", "n_b", "n_groups", "n_links", "n_shared")},
        "groups": pa.string(), **{n: pa.list_(pa.int64()) for n in _LONGS}}


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = FOLDER,
                 full: bool = True) -> DataFrame:
    """Both token sequences of every text and how they meet, one row per input row.

    Columns: id_col, row (a number of the row), n_a, n_b, n_groups, n_links, n_shared (pairs of
    tokens in a common group), groups (``a1,a2|b1;a3|b2``; with ``full`` off its SHA-256), pair
    and times (the text's pairs of linked ids, a << 20 | b, and their links). ``full`` adds the
    ids a and b, link_a, link_b and overlap (token numbers and common bytes of every link) and
    group_a, group_b (the group of every token).

    A text that is null or empty, or that one of the tokenizers does not give back byte by byte
    after a space, has no tokens: zeros and ''. Texts are read whole. Repeated rows and ids are
    rows of their own; a null id stays null; further columns are not read. An empty table gives
    no rows.
    """
    share_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, row long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups string, "
              "pair array<long>, times array<long>")
    if full:
        schema += "".join(f", {c} array<long>" for c in _LONGS[:-2])
    found = rows.mapInArrow(_aligner(folder, full), schema)
    return found.withColumnRenamed("id", id_col)


class Correspondence(NamedTuple):
    """pairs: (pair, a, b, links, best): how often ids are linked, and whether no other a is
    linked with b more often; rows: n_best and count_sum of every row number."""

    pairs: DataFrame
    rows: DataFrame


def correspondence(aligned: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> Correspondence:
    """Links of every pair of ids over all texts, and how well the links of each text agree with them.

    ``aligned`` is a stored result of ``align_tokens``. Links are counted per text and per
    task before they are shuffled. Pairs are at most the product of the vocabularies.
    """
    each = aligned.select("row", F.explode(F.arrays_zip("pair", "times")).alias("x")).select(
        "row", F.col("x.pair").alias("pair"), F.col("x.times").alias("times"))
    counts = store(each.groupBy("pair").agg(F.sum("times").alias("links"), F.count(F.lit(1)).alias("texts")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1))
    tops = counts.groupBy(b.alias("b")).agg(F.max("links").alias("top"))  # one row per id of B
    named = counts.select("*", F.shiftright("pair", ID_BITS).alias("a"), b.alias("b")).join(F.broadcast(tops), "b")
    pairs = store(named.select("pair", "a", "b", "links", "texts", (F.col("links") == F.col("top")).alias("best")), "best-pairs")
    facts = pairs.select("pair", "links", "best", "texts")
    n = facts.count()
    if n * PAIR_BYTES <= broadcast_bytes:
        met = each.join(F.broadcast(facts.drop("texts")), "pair")
    else:
        met = attach_groups(each, facts, ["pair"], "texts", each.count())
    rows = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("links")).alias("count_sum"))
    return Correspondence(pairs.drop("texts"), rows)


@query("op11_cross_tokenizer_alignment")
def op11_cross_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens, groups, links and their corpus-wide counts of every document."""
    aligned = store(align_tokens(read(spark, sf, "documents"), full=False), "aligned")
    agreed = correspondence(aligned).rows
    return aligned.join(agreed, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), F.col("groups").alias("groups_sha256"), "n_shared")
