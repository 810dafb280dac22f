"""Personal data by bootstrapped contextual extraction, in DataFrame expressions only.

Base: four kinds of validated matches (email, ip, card, phone) with code-point positions. They are
the seeds. The one and two words before a seed are its lexical patterns. Each pattern is linked to
the instances that follow it, seeds and loosely shaped candidates alike, and its total use is
counted over all words of all documents. Scores then go round the graph: a pattern scores
the confidence of what follows it over all its uses; an instance, the noisy-or of its patterns.
Candidates that confident patterns vouch for are added as spans of the kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stage

KINDS = ("email", "ip", "card", "phone")
#: Distinct seeds a pattern needs, least pattern and instance confidence, rounds over the graph.
MIN_SEEDS, MIN_PATTERN, MIN_INSTANCE, ROUNDS = 3, 0.5, 0.8, 3
#: Patterns that a broadcast join may hold (16 bytes each); beyond, the join shuffles.
BROADCAST_PATTERNS = 500_000
#: Possessive groups do not recurse; a match starts at the start of a run, or where the last ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Looser shapes of whole tokens, for candidates.
LOOSE = {
    "email": r"(?<!\S)[^\s@\[(]++(?:@|\[at\]|\(at\))[^\s,;]*[A-Za-z0-9]",
    "ip": r"(?<!\S)(?:[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}+|[0-9]{1,3}(?:\[\.\][0-9]{1,3}){3})(?=[.,;]?(?:\s|$))",
    "card": r"(?<!\S)[0-9](?:[\x20-]?[0-9]){11,18}+(?=[.,;]?(?:\s|$))",
    "phone": r"(?<!\S)\(?[0-9]{2,4}\)?(?:[\x20.-][0-9]{2,5}){1,4}+(?=[.,;]?(?:\s|$))",
}
_CHUNK = 256
_STARTS = "array<bigint>"


def offsets(lengths: Column) -> Column:
    """Exclusive running sums of an array; in chunks, so that long arrays cost n**1.5 and not n**2."""
    chunks = F.transform(F.sequence(F.lit(0), F.size(lengths) - 1, F.lit(_CHUNK)), lambda i: F.slice(lengths, i + 1, _CHUNK))
    zero = F.lit(0).cast("long")
    sums = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda a, x: a + x))
    run = lambda values, first: F.aggregate(
        values, F.struct(F.array().cast(_STARTS).alias("out"), first.alias("at")),
        lambda a, x: F.struct(F.concat(a["out"], F.array(a["at"])).alias("out"), (a["at"] + x).alias("at")), lambda a: a["out"])
    pairs = F.arrays_zip(chunks.alias("c"), run(sums, zero).alias("b"))
    out = F.flatten(F.transform(pairs, lambda p: run(p["c"], p["b"])))
    return F.when(F.size(lengths) > 0, out).otherwise(F.array().cast(_STARTS))


def luhn(digits: Column) -> Column:
    d = F.transform(F.split(F.reverse(digits), ""), lambda x: F.ascii(x) - 48)
    twice = F.transform(d, lambda x, i: F.when(i % 2 == 0, x).otherwise(x * 2 - F.when(x > 4, 9).otherwise(0)))
    return F.aggregate(twice, F.lit(0), lambda a, x: a + x) % 10 == 0


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        d = digits_of(m)
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(digits_of(m)).between(9, 15)
    return F.lit(True)


def shaped(kind: str, m: Column) -> Column:
    if kind == "phone":
        return F.length(digits_of(m)).between(7, 15)
    if kind == "ip":
        return m.rlike(r"[0-9A-Fa-f]") & (F.length(m) >= 7)
    return F.lit(True)


def _found(text: Column, kind: str, regex: str, passes, hint: str) -> Column:
    """array<struct<kind, start, end, value, tail>> of the passing matches; ``tail`` is the text
    before a match back to the last one, 80 characters at most."""
    has = text.rlike(hint)
    pieces, matches = F.split(text, regex, -1), F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    length = lambda a: F.transform(a, lambda x: F.length(x).cast("long"))
    gaps = F.transform(F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("p"), matches.alias("m")),
                       lambda z: F.struct(z["p"].alias("p"), z["m"].alias("m")))
    starts = offsets(F.zip_with(length(F.slice(pieces, 1, F.size(matches))), length(matches), lambda a, b: a + b))
    rows = F.zip_with(gaps, starts, lambda g, s: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), (s + F.length(g["p"])).alias("start"),
        (s + F.length(g["p"]) + F.length(g["m"])).alias("end"), g["m"].alias("value"), F.substring(g["p"], -80, 80).alias("tail")))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint,value:string,tail:string>>")
    return F.when(has, F.filter(rows, lambda r: passes(kind, r["value"]))).otherwise(none)


_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_LOOSE_HINT = {"email": r"@|\[at\]|\(at\)", "ip": r"[0-9A-Fa-f]:|\[\.\]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"[0-9]{2}\)?[\x20.-][0-9]{2}"}


def _patterns(tail: Column) -> Column:
    """Hashes of the last word and of the last two words of a text, lower-cased."""
    words = F.filter(F.split(F.lower(tail), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    one, two = F.element_at(words, -1), F.element_at(words, -2)
    return (F.when(F.size(words) > 1, F.array(F.xxhash64(one), F.xxhash64(two, one)))
            .when(F.size(words) == 1, F.array(F.xxhash64(one))).otherwise(F.array().cast("array<bigint>")))


def matches(docs: DataFrame) -> DataFrame:
    """_rid, doc_id, base, loose: validated and candidate spans of each row, each an array of
    struct<kind, start, end, value (a hash), patterns (hashes)>."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def spans(regexes, passes, hints) -> Column:
        found = F.concat(*[_found(text, k, regexes[k], passes, hints[k]) for k in KINDS])
        return F.transform(found, lambda r: F.struct(
            r["kind"].alias("kind"), r["start"].alias("start"), r["end"].alias("end"),
            F.xxhash64(r["value"]).alias("value"), _patterns(r["tail"]).alias("patterns")))

    return docs.select("_rid", "doc_id", spans(BASE, valid, _HINT).alias("base"), spans(LOOSE, shaped, _LOOSE_HINT).alias("loose"))


def pattern_uses(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often each pattern (hash ``p``) occurs before a word, over all texts."""
    words = F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[\x20\x09-\x0D]+")
    both = F.flatten(F.transform("w", lambda x, i: F.array(F.xxhash64(x), F.xxhash64(F.get("w", i - 1), x))))
    known = F.broadcast(patterns) if patterns.count() <= BROADCAST_PATTERNS else patterns
    return (docs.select(words.alias("w")).select(F.explode(both).alias("p")).join(known, "p", "left_semi")
            .groupBy("p").agg(F.count(F.lit(1)).alias("uses")))


def discovered(docs: DataFrame, found: DataFrame, min_seeds: int = MIN_SEEDS, min_pattern: float = MIN_PATTERN,
               min_instance: float = MIN_INSTANCE, rounds: int = ROUNDS) -> DataFrame | None:
    """_rid, kind, start, end of the candidates that confident patterns vouch for; None if no
    pattern has seeds enough."""
    flat = lambda c: found.select("_rid", F.explode(c).alias("s")).select("_rid", "s.*")
    seeds = flat("base")
    loose = flat("loose").join(seeds.select("_rid", "kind", "start"), ["_rid", "kind", "start"], "left_anti")
    seed_edges = seeds.select("kind", "value", F.explode("patterns").alias("p"))
    known = (seed_edges.groupBy("kind", "p").agg(F.count_distinct("value").alias("n")).where(F.col("n") >= min_seeds).select("kind", "p"))
    known = stage(known, "patterns")
    if known.isEmpty():
        return None
    edges = (seed_edges.withColumn("seed", F.lit(1.0)).unionAll(
        loose.select("kind", "value", F.explode("patterns").alias("p"), F.lit(0.0).alias("seed")))
        .join(known, ["kind", "p"], "left_semi").groupBy("kind", "p", "value").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")))
    edges = stage(edges, "edges")
    uses = stage(pattern_uses(docs, known.select("p").distinct()), "uses")
    belief = edges.groupBy("kind", "value").agg(F.max("seed").alias("belief"))
    for _ in range(rounds):
        score = (edges.join(belief, ["kind", "value"]).groupBy("kind", "p").agg(F.sum(F.col("n") * F.col("belief")).alias("good"))
                 .join(uses, "p").select("kind", "p", F.least(F.lit(1.0), F.col("good") / F.col("uses")).alias("score"))
                 .where(F.col("score") >= min_pattern))
        doubt = F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9))))
        vouched = edges.join(score, ["kind", "p"]).groupBy("kind", "value").agg((1 - F.exp(doubt)).alias("vouched"))
        belief = stage(edges.groupBy("kind", "value").agg(F.max("seed").alias("seed")).join(vouched, ["kind", "value"], "left")
                       .select("kind", "value", F.greatest("seed", F.coalesce("vouched", F.lit(0.0))).alias("belief")), "belief")
    sure = belief.where(F.col("belief") >= min_instance).select("kind", "value")
    trusted = stage(score.select("kind", "p"), "trusted")
    # the candidate must stand after a trusted pattern here, and its value be believed
    here = loose.select("_rid", "kind", "start", "end", "value", F.explode("patterns").alias("p")).join(trusted, ["kind", "p"], "left_semi")
    return here.join(sure, ["kind", "value"], "left_semi").select("_rid", "kind", "start", "end").distinct()


def extract(docs: DataFrame, **params) -> DataFrame:
    """doc_id, base and added (arrays of struct<kind, start, end>) of every row of ``docs``.

    Code-point positions, end exclusive; sorted by kind (as KINDS) and start. Null texts are
    empty. An added span overlaps no base span. An empty table gives no rows.
    """
    rows = stage(docs.select("doc_id", "text").withColumn("_rid", F.monotonically_increasing_id()), "pii-docs")
    found = stage(matches(rows), "pii-matches")
    more = discovered(rows, found, **params)
    bare = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    out = found.select("_rid", "doc_id", bare.alias("base"))
    empty = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    if more is None:
        return out.select("doc_id", "base", empty.alias("added"))
    more = more.groupBy("_rid").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added"))
    free = F.filter("added", lambda a: ~F.exists("base", lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))
    return out.join(more, "_rid", "left").select("doc_id", "base", F.coalesce(free, empty).alias("added"))


def op1(docs: DataFrame) -> DataFrame:
    """Digest of ``extract``: counts of base spans, their SHA-256, all spans, and how many were added."""
    e = extract(docs)
    name = F.array(*[F.lit(k) for k in KINDS])
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return e.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                    F.sha2(text("base"), 256).alias("base_sha256"),
                    text(F.when(F.size("added") == 0, F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))).alias("spans"),
                    F.size("added").cast("long").alias("n_added"))
