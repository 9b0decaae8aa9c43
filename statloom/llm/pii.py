"""Personal data: base patterns as seeds, and identifiers that their lexical contexts give away."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.llm.common import SPACE, ascii_lower, attach_groups, query, read, store, text_hash

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Possessive quantifiers and the look behind change no match: they only
# keep long runs of letters or digits from being tried again at every place.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# An identifier is a word with a digit or an @, or a row of short groups of digits.
_GROUP = r"[().+-]{0,3}[0-9][0-9().+-]{0,9}(?![^\x20\x09-\x0D])"
_WORD = r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
IDENTIFIER = rf"(?<![^\x20\x09-\x0D])(?:{_GROUP}(?:\x20{_GROUP})*+|{_WORD})"
# What an identifier of a kind looks like at least, where no base pattern matches it.
LOOSE = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+$",
    "ip": r"^(?:[0-9]{1,3}(?:\.[0-9xX*]{1,3}){3}|[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7})$",
    "card": r"^(?=(?:[^0-9]*[0-9]){12,19}[^0-9]*$)[0-9][0-9 -]+$",
    "phone": r"^(?=(?:[^0-9]*[0-9]){7,15}[^0-9]*$)[0-9+(][0-9 ().-]+$",
}
# Characters at the ends of a word that belong to the sentence.
MARKS = "!\"#$%&'*,./:;<=>?[\\]^`{|}~"
# Code points on either side of an identifier that its context may take words from.
WINDOW = 64
# A pattern needs so many trusted instances, and this share of all that contradict or support it.
MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.95
# A pattern's confidence counts one contradiction that was not seen.
PRIOR = 1.0
# Belief from which on an instance is trusted.
TRUST = 0.95
ROUNDS = 3
# Elements that a running sum takes in one go.
CHUNK = 256


class Pii(NamedTuple):
    """rows: one per input row (id_col, base and found: arrays of (kind, start, end), kind by
    its place in KINDS); patterns: the accepted contexts (pattern, kind, support, confidence);
    instances: the identifiers they gave away (i0, i1: hashes, kind, belief)."""

    rows: DataFrame
    patterns: DataFrame
    instances: DataFrame


# --- places of matches -------------------------------------------------------------


def _each(n: Column, make: Callable[[Column], Column]) -> Column:
    return F.transform(F.sequence(F.lit(0), n - 1), make)


def _sums(a: Column) -> Column:
    """0 and the running sums of an array of longs."""
    return F.aggregate(a, F.array(F.lit(0).cast("long")),
                       lambda acc, x: F.concat(acc, F.array(F.element_at(acc, F.lit(-1)) + x)))


def _located(rows: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Add per pattern the array of its matches: (start, stop, word, left, right).

    Offsets are code points from 0; left and right are the texts around, WINDOW code points at
    most. What stands between the matches gives their places: the text is split once more
    where there are any. Lengths are added up in parts, so many matches cost no square.
    """
    kept, names = rows.columns, list(patterns)
    rows = rows.select(*kept, *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}")
                                for k, p in patterns.items()))
    rows = rows.select("*", *(F.when(F.size(f"m_{k}") > 0, F.split("text", p, -1)).alias(f"p_{k}")
                              for k, p in patterns.items()))
    size = lambda k: F.size(f"m_{k}")
    there = lambda k, c: F.when(F.col(f"p_{k}").isNotNull(), c)
    length = lambda k: _each(size(k), lambda i: (
        F.length(F.get(f"p_{k}", i)) + F.length(F.get(f"m_{k}", i))).cast("long"))
    rows = rows.select("*", *(there(k, length(k)).alias(f"l_{k}") for k in names))
    parts = lambda k: F.transform(F.sequence(F.lit(1), F.size(f"l_{k}"), F.lit(CHUNK)),
                                  lambda at: F.slice(f"l_{k}", at, F.lit(CHUNK)))
    rows = rows.select("*", *(there(k, parts(k)).alias(f"c_{k}") for k in names))
    zero = F.lit(0).cast("long")
    whole = lambda k: _sums(F.transform(f"c_{k}", lambda c: F.aggregate(c, zero, lambda a, x: a + x)))
    rows = rows.select("*", *(there(k, whole(k)).alias(f"w_{k}") for k in names))
    # As arguments of zip_with the sums are made once, not once per element.
    before = lambda k: F.flatten(F.zip_with(
        f"c_{k}", F.slice(f"w_{k}", F.lit(1), F.size(f"c_{k}")),
        lambda c, w: F.transform(F.slice(_sums(c), F.lit(1), F.size(c)), lambda x: x + w)))
    rows = rows.select("*", *(there(k, before(k)).alias(f"b_{k}") for k in names))

    def match(k: str, i: Column) -> Column:
        start = F.get(f"b_{k}", i) + F.length(F.get(f"p_{k}", i))
        stop = F.get(f"b_{k}", i) + F.length(F.get(f"p_{k}", i)) + F.length(F.get(f"m_{k}", i))
        return F.struct(start.alias("start"), stop.alias("stop"), F.get(f"m_{k}", i).alias("word"),
                        F.right(F.get(f"p_{k}", i), F.lit(WINDOW)).alias("left"),
                        F.left(F.get(f"p_{k}", i + 1), F.lit(WINDOW)).alias("right"))

    none = F.expr("cast(array() as array<struct<start:bigint,stop:bigint,word:string,left:string,right:string>>)")
    matches = lambda k: there(k, _each(size(k), lambda i: match(k, i)))
    return rows.select(*kept, *(F.coalesce(matches(k), none).alias(f"s_{k}") for k in names))


# --- base identifiers --------------------------------------------------------------


def _digits(word: Column) -> Column:
    return F.regexp_replace(word, "[^0-9]", "")


def valid(kind: str, word: Column) -> Column:
    """Is a match of a base pattern an identifier?"""
    if kind == "ip":
        part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return word.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        number = F.length(_digits(word)).between(13, 19)
        return F.when(number, F.call_function("luhn_check", _digits(word))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(word)).between(9, 15)
    return F.lit(True)


def _holds_base(word: Column) -> Column:
    """Does a word hold a base identifier of any kind?"""
    found = lambda k: F.exists(F.regexp_extract_all(word, F.lit(PATTERNS[k]), F.lit(0)), lambda w: valid(k, w))
    return reduce(lambda a, b: a | b, map(found, KINDS))


# --- contexts ----------------------------------------------------------------------


def _context_words(text: Column) -> Column:
    """Words of a context: A-Z lower-cased, every digit a 0, without marks at their ends."""
    plain = F.regexp_replace(ascii_lower(text), "[0-9]", "0")
    words = F.transform(F.split(plain, f"{SPACE}+"), lambda w: F.btrim(w, F.lit(MARKS)))
    return F.filter(words, lambda w: w != "")


def _contexts(m: Column) -> Column:
    """The patterns of one occurrence: two words before, one on each side, two words behind.

    ^ and $ stand for the ends of the text; a pattern holds one word at least.
    """
    before, after = _context_words(m["left"]), _context_words(m["right"])
    last = F.array(F.coalesce(F.get(before, F.size(before) - 2), F.lit("^")),
                   F.coalesce(F.get(before, F.size(before) - 1), F.lit("^")))
    next_ = F.array(F.coalesce(F.get(after, F.lit(0)), F.lit("$")), F.coalesce(F.get(after, F.lit(1)), F.lit("$")))
    made = F.array(
        F.concat(F.lit("L "), F.array_join(last, " ")),
        F.concat_ws(" ", F.lit("B"), F.get(last, F.lit(1)), F.lit("_"), F.get(next_, F.lit(0))),
        F.concat(F.lit("R "), F.array_join(next_, " ")))
    return F.filter(made, lambda p: ~p.isin("L ^ ^", "B ^ _ $", "R $ $"))


def _mask(word: Column) -> Column:
    """The kinds an identifier may be of, one bit each."""
    bits = [F.when(word.rlike(LOOSE[k]), 1 << i).otherwise(0) for i, k in enumerate(KINDS)]
    return reduce(lambda a, b: a + b, bits)


def _occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id, k0, t0, t1 (hashes of id and text), base spans and identifiers.

    known: base identifiers with their kind; open: identifiers that no base pattern matches.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("k0"), text.alias("text"))
    rows = rows.select("*", *(h.alias(f"t{i}") for i, h in enumerate(text_hash(F.col("text")))))
    rows = _located(rows, {**PATTERNS, "open": IDENTIFIER})
    good = lambda k: F.filter(f"s_{k}", lambda m: valid(k, m["word"]))
    rows = rows.select("id", "k0", "t0", "t1", "s_open", *(good(k).alias(f"s_{k}") for k in KINDS))
    span = lambda i: F.transform(f"s_{KINDS[i]}", lambda m: F.struct(
        F.lit(i).alias("kind"), m["start"].alias("start"), m["stop"].alias("stop")))
    seed = lambda i: F.transform(f"s_{KINDS[i]}", lambda m: F.struct(
        *(h.alias(f"i{j}") for j, h in enumerate(text_hash(m["word"]))), F.lit(i).alias("kind"),
        _contexts(m).alias("patterns")))
    base, known = (F.concat(*map(make, range(len(KINDS)))) for make in (span, seed))
    free = F.filter("s_open", lambda m: ~_holds_base(m["word"]))
    cut = lambda m: F.btrim(m["word"], F.lit(MARKS))
    ahead = lambda m: F.length(m["word"]) - F.length(F.ltrim(m["word"], F.lit(MARKS)))
    open_ = F.transform(free, lambda m: F.struct(
        *(h.alias(f"i{j}") for j, h in enumerate(text_hash(cut(m)))), _mask(cut(m)).alias("mask"),
        (m["start"] + ahead(m)).alias("start"), (m["start"] + ahead(m) + F.length(cut(m))).alias("stop"),
        _contexts(m).alias("patterns")))
    return rows.select("id", "k0", "t0", "t1", base.alias("base"), known.alias("known"),
                       F.filter(open_, lambda o: o["stop"] > o["start"]).alias("open"))


# --- the graph of patterns and instances -------------------------------------------


def _graph(rows: DataFrame, min_support: int) -> DataFrame:
    """Edges (p, i0, i1, kind of a base identifier or null, mask), each once.

    Patterns with fewer instances than any accepted one are left out: no round can take them.
    """
    known = rows.select(F.explode("known").alias("x")).select(
        F.explode("x.patterns").alias("p"), "x.i0", "x.i1", "x.kind", F.lit(0).alias("mask"))
    open_ = rows.select(F.explode("open").alias("x")).select(
        F.explode("x.patterns").alias("p"), "x.i0", "x.i1", F.lit(None).cast("int").alias("kind"), "x.mask")
    edges = known.union(open_).groupBy("p", "i0", "i1").agg(F.min("kind").alias("kind"), F.max("mask").alias("mask"))
    edges = store(edges, "pii-edges")
    sizes = edges.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count("kind").alias("seeds"))
    rich = store(sizes.filter((F.col("n") >= min_support) & (F.col("seeds") > 0)), "pii-patterns")
    kept = attach_groups(edges, rich, ["p"], "n", edges.count())
    return store(kept.filter(F.col("n").isNotNull()).drop("seeds"), "pii-graph")


def _score_patterns(graph: DataFrame, beliefs: DataFrame, total: int, min_support: int,
                    min_confidence: float) -> DataFrame:
    """Accepted patterns (p, kind, support, confidence, n).

    For a kind, trusted instances of it count for a pattern, and against it count trusted
    ones of other kinds and unknown ones that cannot be of the kind.
    """
    now = attach_groups(graph.drop("n"), beliefs, ["i0", "i1"], "degree", total)
    is_, mask = F.col("told"), F.col("mask")
    sums = []
    for k in range(len(KINDS)):
        mine = F.coalesce(is_ == k, F.lit(False))
        against = F.when(is_.isNotNull(), is_ != k).otherwise(mask.bitwiseAND(F.lit(1 << k)) == 0)
        sums += [F.sum(F.when(mine, F.col("belief")).otherwise(0.0)).alias(f"for{k}"),
                 F.count_if(mine).alias(f"support{k}"), F.count_if(against).alias(f"against{k}")]
    table = now.groupBy("p").agg(F.count(F.lit(1)).alias("n"), *sums)
    scored = F.array(*(F.struct(
        F.lit(k).alias("kind"), F.col(f"support{k}").alias("support"),
        (F.col(f"for{k}") / (F.col(f"support{k}") + F.col(f"against{k}") + PRIOR)).alias("confidence"))
        for k in range(len(KINDS))))
    long = table.select("p", "n", F.explode(scored).alias("s")).select("p", "n", "s.*")
    good = long.filter((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
    # Two kinds can only both pass if half the instances contradict neither: the surer one counts.
    return good.groupBy("p", "n").agg(F.max_by(F.struct("kind", "support", "confidence"),
                                               F.struct("confidence", -F.col("kind"))).alias("s")).select("p", "n", "s.*")


def _score_instances(graph: DataFrame, patterns: DataFrame, total: int, trust: float) -> DataFrame:
    """Trusted unseen instances (i0, i1, told, belief): 1 less the chance that all their patterns err."""
    unseen = graph.filter("kind IS NULL").select("p", "i0", "i1", "mask")
    told = patterns.select("p", F.col("kind").alias("told"), "confidence", "n")
    met = attach_groups(unseen, told, ["p"], "n", total)
    fits = F.expr("(mask & shiftleft(1, told)) <> 0")
    each = met.filter(F.col("told").isNotNull() & fits).groupBy("i0", "i1", "told").agg(
        (1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("belief"))
    best = each.groupBy("i0", "i1").agg(
        F.max_by(F.struct("told", "belief"), F.struct(F.round("belief", 9), -F.col("told"))).alias("b"))
    return best.select("i0", "i1", "b.told", "b.belief").filter(F.col("belief") >= trust)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_support: int = MIN_SUPPORT,
             min_confidence: float = MIN_CONFIDENCE, trust: float = TRUST, rounds: int = ROUNDS) -> Pii:
    """Base identifiers of every text, and identifiers that the contexts of known ones reveal.

    Seeds are the matches of the base patterns. Their contexts (the words around them) are
    lexical patterns. Every round scores patterns by the instances they are trusted for
    against those that contradict them, and unknown identifiers by the patterns they stand
    in; what is trusted then counts in the next round. An identifier that is trusted at the
    end is marked wherever it stands, but never over a base span.

    A null text is empty and has no spans; texts of any length are read whole; repeated rows
    get equal results, and count once for a pattern; further columns are not read. An empty
    table gives no rows. Without trusted patterns only base spans are returned.
    """
    rows = store(_occurrences(docs, id_col, text_col), "pii")
    graph = _graph(rows, min_support)
    total = graph.count()
    degrees = graph.groupBy("i0", "i1").agg(F.count(F.lit(1)).alias("degree"), F.min("kind").alias("told"))
    degrees = store(degrees, "pii-degrees")
    seeds = degrees.filter("told IS NOT NULL").select("i0", "i1", "degree", "told", F.lit(1.0).alias("belief"))
    beliefs = seeds
    for turn in range(rounds):
        patterns = store(_score_patterns(graph, beliefs, total, min_support, min_confidence), "pii-accepted")
        found = store(_score_instances(graph, patterns, total, trust), "pii-found")
        if turn + 1 < rounds:
            if found.isEmpty():
                break  # the next round would be this one again
            grown = degrees.filter("told IS NULL").select("i0", "i1", "degree").join(found, ["i0", "i1"])
            beliefs = seeds.unionByName(grown)

    places = rows.select("k0", "t0", "t1", F.explode("open").alias("o")).select(
        "k0", "t0", "t1", "o.i0", "o.i1", "o.start", "o.stop")
    none = F.expr("cast(array() as array<struct<kind:int,start:bigint,stop:bigint>>)")
    if found.isEmpty():
        given = rows.withColumn("found", none)
    else:
        counts = places.groupBy("i0", "i1").agg(F.count(F.lit(1)).alias("places"))
        named = store(found.join(counts, ["i0", "i1"]), "pii-named")
        hit = attach_groups(places, named, ["i0", "i1"], "places", places.count()).filter("told IS NOT NULL")
        spans = hit.groupBy("k0", "t0", "t1").agg(F.array_sort(F.collect_set(F.struct(
            F.col("told").alias("kind"), "start", "stop"))).alias("found"))
        twins = rows.groupBy("k0", "t0", "t1").agg(F.count(F.lit(1)).alias("rows"))
        spans = store(spans.join(twins, ["k0", "t0", "t1"]), "pii-spans")
        given = attach_groups(rows.select("id", "k0", "t0", "t1", "base"), spans, ["k0", "t0", "t1"], "rows", rows.count())
        over = lambda s: F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
        given = given.withColumn("found", F.filter(F.coalesce("found", none), lambda s: ~over(s)))
    return Pii(given.select(F.col("id").alias(id_col), "base", "found"),
               patterns.select(F.col("p").alias("pattern"), F.get(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("kind"),
                               "support", "confidence"),
               found.select("i0", "i1", F.get(F.array(*map(F.lit, KINDS)), F.col("told")).alias("kind"), "belief"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


@query("op13_pii")
def op13_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Base identifiers of every document by kind, and all spans with those that contexts add."""
    rows = find_pii(read(spark, sf, "documents")).rows
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return rows.select(
        "doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)), F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("base", "found"))).alias("spans"),
        F.size("found").cast("long").alias("n_found"))
