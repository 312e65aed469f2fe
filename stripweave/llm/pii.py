"""Personal data by bootstrapped contextual extraction, in DataFrame functions alone.

Fixed patterns give the base spans, whose values are the seeds. The words around them
give lexical patterns; other identifier-like strings in the same contexts are instances.
Patterns and instances are scored over their bipartite graph in rounds: a pattern by the
scores of the distinct instances it occurs with, an instance by the patterns that hold
it. What high-confidence patterns discover is added to the spans; base spans stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import split_join, written

# The base patterns for a leftmost, non-overlapping search. Possessive quantifiers and the look-behinds
# change no match: they keep the search linear, and the stack flat, on long runs of one kind of character.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
#: Identifier-like: tokens without white space that hold a digit or an at sign, and further ones that hold
#: digits and no letter, after one space each. The base kinds without their strict parts look so.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[^\sA-Za-z0-9@]*+[0-9][^\sA-Za-z@]*+(?!\S))*+"
#: Code points on either side in which context words are looked for. A word cut by the reach isn't used.
REACH = 80
ROUNDS = 3
#: Distinct instances, seeds or accepted ones, that a pattern must occur with, the pseudo-count against
#: small patterns, and the least confidence of a pattern and score of an instance.
SUPPORT, SMOOTHING, CONFIDENT, ACCEPTED = 3, 1.0, 0.6, 0.6


def occurrences(text: Column, pattern: str) -> Column:
    """Array of ``(gap, match, before, after, value)``: lengths, the text on either side, the match."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(
        found,
        lambda m, i: F.struct(
            F.length(F.get(gaps, i)).cast("long").alias("gap"),
            F.length(m).cast("long").alias("size"),
            F.right(F.get(gaps, i), F.lit(REACH)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(REACH)).alias("after"),
            m.alias("value"),
        ),
    )


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn check digit."""
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    double = lambda x: x * 2 - F.when(x > 4, 9).otherwise(0)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), lambda acc, i: acc + F.when((F.length(digits) - i) % 2 == 1, double(value(i))).otherwise(value(i))
    )
    return total % 10 == 0


def holds(kind: Column, value: Column) -> Column:
    """The conditions on a base match beyond its pattern."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"  # leading zeros don't count; zero is nothing but them
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == "card", F.when(n.between(12, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True)
    )


KEY = ["doc_id", "text_hash"]


def keyed(docs: DataFrame) -> DataFrame:
    """A row's key is its id and its text's hash: rows that share both have the same spans."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def found_in(docs: DataFrame) -> DataFrame:
    """All base matches that hold, and all identifier-like tokens (kind ``token``), with places and contexts."""
    text = F.col("text")
    none = F.expr("cast(array() as array<struct<gap: bigint, size: bigint, before: string, after: string, value: string>>)")
    digit = text.rlike("[0-9]")
    when = {"email": text.contains("@"), "ip": digit, "card": digit, "phone": text.contains("+"), "token": digit | text.contains("@")}
    some = keyed(docs).where(text.rlike("[0-9@]"))
    each = F.array(
        *(F.struct(F.lit(k).alias("kind"), F.when(when[k], occurrences(text, p)).otherwise(none).alias("found")) for k, p in {**PATTERNS, "token": TOKEN}.items())
    )
    rows = some.select(*KEY, F.inline(each)).select(*KEY, "kind", F.posexplode("found").alias("at", "m")).select(*KEY, "kind", "at", "m.*")
    rows = rows.dropDuplicates([*KEY, "kind", "at"])
    order = Window.partitionBy(*KEY, "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.col("size")).over(order)
    rows = rows.withColumn("stop", end).withColumn("start", F.col("stop") - F.col("size"))
    return rows.where(holds(F.col("kind"), F.col("value"))).drop("gap", "size", "at")


def context_words(side: Column, cut_at_start: Column, cut_at_end: Column) -> Column:
    """The words of a context: lower case, digits as ``0``, without punctuation, and whole."""
    whole = F.when(cut_at_start, F.regexp_replace(side, r"^\S+", "")).otherwise(F.when(cut_at_end, F.regexp_replace(side, r"\S+$", "")).otherwise(side))
    plain = F.regexp_replace(F.regexp_replace(F.lower(whole), r"[0-9]+", "0"), r"[^\p{L}0]+", " ")
    return F.filter(F.split(plain, " "), lambda w: w != "")


def patterns_of() -> Column:
    """The lexical patterns of an occurrence: one word, or two, to the left, a word before a gap of one, a word on either side."""
    cut = lambda c: F.length(c) == REACH
    words, after = context_words(F.col("before"), cut("before"), F.lit(False)), context_words(F.col("after"), F.lit(False), cut("after"))
    left, second, right = F.get(words, F.size(words) - 1), F.get(words, F.size(words) - 2), F.get(after, F.lit(0))
    return F.array_compact(
        F.array(
            F.concat(F.lit("l "), left),
            F.concat(F.lit("ll "), second, F.lit(" "), left),
            F.concat(F.lit("lg "), second, F.lit(" _")),
            F.concat(F.lit("lr "), left, F.lit(" | "), right),
        )
    )


def score_patterns(edges: DataFrame, *, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Score ``edges(pattern, instance, kind)``, distinct, where ``kind`` is a seed's and else null.

    Rounds of two steps. A pattern's confidence for a kind is the sum of its instances' scores for
    it over the number of its instances and a pseudo-count, if enough of them are seeds or were accepted
    in the round before. An instance's score is that at least one confident pattern is right,
    ``1 - prod(1 - confidence)``; seeds keep 1. Returns ``(pattern, kind, confidence)`` and ``(instance, kind, score)``.
    """
    edges = written(edges, name="edges")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    seeds = edges.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    scores = seeds
    for _ in range(rounds):
        held = split_join(edges.select("pattern", "instance"), scores, ["instance"])
        strength = held.groupBy("pattern", "kind").agg(F.sum("score").alias("strength"), F.count_if(F.col("score") >= ACCEPTED).alias("support"))
        confident = strength.where(F.col("support") >= SUPPORT).join(sizes.hint("merge"), "pattern")
        confident = confident.select("pattern", "kind", (F.col("strength") / (F.col("n") + SMOOTHING)).alias("confidence")).where(F.col("confidence") >= CONFIDENT)
        confident = written(confident, name="patterns")
        raised = (
            split_join(edges.where("kind is null").select("pattern", "instance"), confident, ["pattern"])
            .groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))).alias("score"))
        )
        scores = written(seeds.unionByName(raised.join(seeds.hint("merge"), ["instance", "kind"], "left_anti")), name="scores")
    return confident, scores


def spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, kind, start, stop, base)``: all spans of every text, in code points, ends exclusive."""
    found = written(found_in(docs), name="found")
    base = found.where("kind <> 'token'")
    taken = base.groupBy(*KEY).agg(F.collect_list(F.struct("start", "stop")).alias("taken"))
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEY]
    tokens = found.where("kind = 'token'").alias("t").join(taken.hint("merge").alias("b"), same, "left").select("t.*", "b.taken")
    tokens = tokens.where(F.col("taken").isNull() | ~F.exists("taken", lambda s: (s.start < F.col("stop")) & (F.col("start") < s.stop))).drop("taken")
    # A token stands without the punctuation around it.
    ahead = F.length("value") - F.length(F.regexp_replace("value", r"^[(\[{<\"'.,;:!?*|]++", ""))
    closing = r"[)\]}>\"'.,;:!?*|$%&#]"
    bare = F.regexp_replace(F.regexp_replace("value", r"^[(\[{<\"'.,;:!?*|]++", ""), rf"(?<!{closing}){closing}++$", "")
    tokens = tokens.withColumn("start", F.col("start") + ahead).withColumn("value", bare).withColumn("stop", F.col("start") + F.length("value"))
    tokens = tokens.where((F.length(F.regexp_replace("value", "[^0-9]", "")) >= 4) | F.contains("value", F.lit("@")))
    every = base.unionByName(tokens.withColumn("kind", F.lit(None).cast("string"))).withColumn("instance", F.lower("value"))
    every = written(every.withColumn("pattern", F.explode_outer(patterns_of())).drop("before", "after", "value"), name="occurrences")
    edges = every.where("pattern is not null").groupBy("pattern", "instance").agg(F.min("kind").alias("kind"))
    confident, scores = score_patterns(edges)
    new = (
        split_join(every.where("kind is null").drop("kind"), confident, ["pattern"])
        .join(scores.where(F.col("score") >= ACCEPTED).hint("merge"), ["instance", "kind"])
        .select(*KEY, "kind", "start", "stop", F.lit(False).alias("base")).distinct()
    )
    return base.select(*KEY, "kind", "start", "stop", F.lit(True).alias("base")).unionByName(new)


def detect(docs: DataFrame) -> DataFrame:
    """The contract's columns for each row of ``docs``.

    A null or empty text has no spans. Rows with a null ``doc_id`` stay; rows that repeat an id stand each
    for themselves. Other columns are ignored; an empty table gives no rows. Whole texts are read.
    """
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    shown = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("stop").cast("string"))
    row = F.struct("start", number.alias("number"), "stop", "base", shown.alias("shown"))
    grouped = spans(docs).groupBy(*KEY).agg(F.array_sort(F.collect_list(row)).alias("all"))
    slim = keyed(docs).drop("text")
    joined = slim.alias("d").join(grouped.hint("merge").alias("g"), [F.col(f"d.{k}").eqNullSafe(F.col(f"g.{k}")) for k in KEY], "left").select("d.doc_id", "g.all")
    every = F.coalesce("all", F.filter("all", lambda x: F.lit(False)), F.expr("cast(array() as array<struct<start: bigint, number: bigint, stop: bigint, base: boolean, shown: string>>)"))
    base = F.filter(every, lambda x: x.base)
    text = lambda a: F.array_join(F.transform(a, lambda x: x.shown), ",")
    count = lambda i: F.size(F.filter(base, lambda x: x.number == i)).cast("long")
    return joined.select(
        "doc_id", *(count(i + 1).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(every).alias("spans"),
    )
