"""Personal data: fixed patterns, and terms that give the protected values away.

Base spans are the matches of four patterns.  A match stands for several protected *entities*, each with an
information of its own: its value (digits alone for cards and phones, so the way of writing does not matter),
what the value belongs to (an email's domain, a phone's digits before the last seven, a card's first six, an
address's first three and first two octets) and its kind.  Values seldom repeat; the wider entities gather support.

A term (a word of three letters or more) discloses an entity e as far as its occurrence near e lowers the information
e has: disclosure(t, e) = PMI(t; e) / IC(e), with PMI(t; e) = log p(t, e) / (p(t) p(e)) and IC(e) = -log p(e).  Probabilities
are shares of all documents; ``near`` is within 80 characters of a match.  It is 1 for a term that no
document has without e near it.  In the documents that hold e, terms at or above ``generalise`` become
a placeholder, and those at or above ``remove`` go.  A pair counts only with ``support`` distinct texts; with a wider
entity, that many documents may hold e that chance alone makes such a pair, so the chance (Chernoff's bound
for the share of the term's documents that have e near it) must be at most ``chance`` as well.

Everything is DataFrame functions: no Python runs on the executors.  A document's spans stay in its own row; words
are counted by partial aggregation, and pairs are joined on (entity, lane of the term) and (entity, term), so an entity
that a third of all documents hold is spread by its terms.  The work on a text grows as n log n with its matches.

Null texts count as empty; null ids stay null.  Rows that repeat are judged each for itself; copies of a
text count as one of ``support``.  Positions are code points, the end is exclusive.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediamart.llm.common import store, text_of

#: The four patterns.  Quantifiers that can never give anything back are possessive, and a match starts
#: where a run of its characters does: the same matches, in time linear in the text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
#: A cheap sign that a text may hold the kind at all.
_SIGNS = {"email": "@", "ip": ".", "phone": "+"}
_OCTET = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"
_WORD = r"\p{L}{3,}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, -place, F.lit(1)).cast("int")
        double = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(double - F.when(double > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$")
    if kind == "card":
        n = F.length(_digits(value))
        return F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def scan(values: Column, join) -> Column:
    """Running ``join`` (associative, such as a sum) of an array, by doubling steps: n log n, where a fold that
    appends to an array copies it n times."""

    def step(done: Column, power: Column) -> Column:
        back = F.pow(F.lit(2), power).cast("int")
        return F.transform(done, lambda x, at: F.when(at < back, x).otherwise(join(F.get(done, at - back), x)))

    steps = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
    # power -1 stands for no step at all: an array of one
    powers = F.filter(F.sequence(F.lit(-1), steps - 1), lambda power: power >= 0)
    return F.aggregate(powers, values, step)


def once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def located(text: Column, pattern: Column, kind: str, valid=None) -> Column:
    """All (valid) matches as spans in order: the lengths of the matches and of what is between them, added up, give
    their places."""
    pieces = F.zip_with(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        F.split(text, pattern, -1),
        lambda v, gap: F.struct(
            v.alias("value"), F.length(v).cast("bigint").alias("size"), F.length(gap).cast("bigint").alias("gap")
        ),
    )

    def placed(found: Column) -> Column:
        ends = scan(F.transform(found, lambda x: x["gap"] + F.coalesce(x["size"], F.lit(0))), lambda x, y: x + y)
        return F.zip_with(
            found,
            ends,
            lambda x, end: F.struct(F.lit(kind).alias("kind"), (end - x["size"]).alias("start"), end.alias("end"), x["value"].alias("value")),
        )

    # the gap behind the last match comes with no value
    return F.filter(once(pieces, placed), lambda s: s["value"].isNotNull() & (F.lit(True) if valid is None else valid(s["value"])))


def base_spans(text: Column) -> Column:
    """The base spans by kind, then start."""
    none = F.expr(f"CAST(array() AS {SPAN})")
    parts = []
    for kind, pattern in PATTERNS.items():
        spans = located(text, F.lit(pattern), kind, partial(_valid, kind))
        sign = F.instr(text, _SIGNS[kind]) > 0 if kind in _SIGNS else text.rlike("[0-9]{2}|[0-9][ -][0-9]")
        parts.append(F.when(sign & text.rlike(pattern), spans).otherwise(none))
    return F.concat(*parts)


def same(kind: str):
    return lambda found: found == kind


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def near_each(text: Column, spans: Column, around: int) -> Column:
    """The spans with ``near``, the ``around`` characters on either side.  They are cut from pieces of the text, since
    cutting from the text walks it from its start for each span."""
    size = max(1024, around)
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))

    def cut(of: Column, at: Column, n: Column | int) -> Column:
        piece = F.floor(at / size).cast("int")
        both = F.concat(F.coalesce(F.get(of, piece), F.lit("")), F.coalesce(F.get(of, piece + 1), F.lit("")))
        return F.substring(both, (at % size).cast("int") + 1, n if isinstance(n, int) else n.cast("int"))

    def told(of: Column) -> Column:
        def one(s: Column) -> Column:
            first = F.greatest(s["start"] - around, F.lit(0))
            near = F.concat_ws(" ", cut(of, first, s["start"] - first), cut(of, s["end"], F.lit(around)))
            return F.struct(s["kind"].alias("kind"), s["value"].alias("value"), near.alias("near"))

        return F.transform(spans, one)

    return once(pieces, told)


def apart(terms: Column, spans: Column) -> Column:
    """The terms that overlap no span: none before reaches into them, and the next one starts behind them."""
    of = lambda items, term: F.transform(
        items, lambda s: F.struct(s["start"].alias("start"), F.lit(term).alias("term"), s.alias("span"))
    )
    far = F.lit(2**62)

    def free(both: Column) -> Column:
        before = scan(F.transform(both, lambda x: F.when(x["term"], F.lit(0)).otherwise(x["span"]["end"])), F.greatest)
        starts = F.transform(both, lambda x: F.when(x["term"], far).otherwise(x["span"]["start"]))
        after = F.reverse(scan(F.reverse(starts), F.least))
        reach = F.zip_with(before, after, lambda x, y: F.struct(x.alias("before"), y.alias("after")))
        judged = F.zip_with(both, reach, lambda x, r: F.struct(x.alias("x"), r.alias("r")))
        kept = F.filter(
            judged, lambda j: j["x"]["term"] & (j["r"]["before"] <= j["x"]["span"]["start"]) & (j["r"]["after"] >= j["x"]["span"]["end"])
        )
        return F.transform(kept, lambda j: j["x"]["span"])

    return once(F.array_sort(F.concat(of(spans, False), of(terms, True))), free)


def lanes(entity: Column) -> Column:
    """Parts into which an entity's terms are dealt for the join with its count: a kind may be near every term, a
    domain or network near very many."""
    return F.when(entity.isin(KINDS), 1024).when(entity.contains(":value:"), 1).otherwise(32)


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0)))


def entities(span: Column) -> Column:
    """What a span's value stands for: the value first, then the wider entities, the kind last."""
    kind, value = span["kind"], F.lower(span["value"])
    digits, octets = _digits(value), F.transform(F.split(value, r"\."), lambda o: o.cast("int").cast("string"))
    named = lambda what, x: F.concat_ws(":", kind, F.lit(what), x)
    return (
        F.when(kind == "email", F.array(named("value", value), named("domain", F.substring_index(value, "@", -1)), kind))
        .when(kind == "card", F.array(named("value", digits), named("issuer", F.substring(digits, 1, 6)), kind))
        .when(kind == "phone", F.array(named("value", digits), named("prefix", F.left(digits, F.length(digits) - 7)), kind))
        .otherwise(
            F.array(
                named("value", F.array_join(octets, ".")),
                named("net", F.array_join(F.slice(octets, 1, 3), ".")),
                named("net", F.array_join(F.slice(octets, 1, 2), ".")),
                kind,
            )
        )
    )


def disclosures(
    docs: DataFrame, base: DataFrame, around: int, support: int, generalise: float, remove: float, chance: float
) -> DataFrame:
    """(entity, term, disclosure, removed) of the pairs at or above the threshold."""
    mentions = (
        base.filter("size(spans) > 0")
        .select("row", "text_key", F.explode(near_each(F.col("text"), F.col("spans"), around)).alias("span"))
        .select("row", "text_key", "span.near", F.explode(entities(F.col("span"))).alias("entity"))
    )
    pairs = (
        mentions.select("row", "text_key", "entity", F.explode(_words(F.col("near"))).alias("term"))
        .distinct()
        .groupBy("entity", "term", "text_key")
        .agg(F.count("*").alias("n"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("n_pair"), F.count("*").alias("n_texts"))
        .filter(F.col("n_texts") >= support)
    )
    held = mentions.select("row", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    documents = base.count()
    counts = (
        docs.select(F.explode(_words(text_of())).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    )
    information = -F.log(F.col("n_entity") / documents)
    pmi = F.log(F.col("n_pair") * float(documents) / (F.col("n_term") * F.col("n_entity")))
    share, rate = F.col("n_pair") / F.col("n_term"), F.col("n_entity") / float(documents)
    without = F.when(share < 1, (1 - share) / share * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    unlikely = F.col("n_texts") * (pmi + without) >= -math.log(chance)
    return (
        pairs.withColumn("lane", F.pmod(F.xxhash64("term"), lanes(F.col("entity"))).cast("int"))
        .join(held.withColumn("lane", F.explode(F.sequence(F.lit(0), lanes(F.col("entity")) - 1))), ["entity", "lane"])
        .join(counts, "term")
        .filter(F.col("n_entity") < documents)
        .filter(F.col("entity").contains(":value:") | unlikely)
        .withColumn("disclosure", pmi / information)
        .filter(F.col("disclosure") >= generalise)
        .select("entity", "term", "disclosure", (F.col("disclosure") >= remove).alias("removed"))
    )


def find(
    docs: DataFrame,
    around: int = 80,
    support: int = 3,
    generalise: float = 0.8,
    remove: float = 0.95,
    chance: float = 1e-4,
) -> DataFrame:
    """One row per document: doc_id, text (of documents with spans only), base, terms, removed.

    ``base`` and ``terms`` are spans; ``removed`` lists the terms that go rather than being generalised.
    """
    text = text_of()
    base = store(
        docs.select("doc_id", text.alias("text"), F.xxhash64(text, F.length(text)).alias("text_key"))
        .withColumn("spans", base_spans(F.col("text")))
        .select(
            "doc_id",
            "text_key",
            F.monotonically_increasing_id().alias("row"),
            "spans",
            F.when(F.size("spans") > 0, F.col("text")).alias("text"),
        ),
        "pii-base",
    )
    pairs = store(disclosures(docs, base, around, support, generalise, remove, chance), "pii-pairs")
    holding = base.filter("size(spans) > 0")
    mentions = (
        holding.select("row", F.explode("spans").alias("span"))
        .select("row", F.explode(entities(F.col("span"))).alias("entity"))
        .distinct()
    )
    words = holding.select("row", F.explode(_words(F.col("text"))).alias("term"))
    of_row = (
        words.join(pairs.select("term").distinct(), "term")
        .join(mentions, "row")
        .join(pairs, ["entity", "term"])
        .groupBy("row", "term")
        .agg(F.bool_or("removed").alias("removed"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("term", "removed"))).alias("found"))
    )
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("found.term", "|"), F.lit(r")(?!\p{L})"))
    terms = (
        holding.join(of_row, "row")
        .withColumn("terms", apart(located(F.col("text"), pattern, "term"), F.col("spans")))
        .select("row", "terms", F.transform(F.filter("found", lambda f: f["removed"]), lambda f: f["term"]).alias("removed"))
    )
    return base.join(terms, "row", "left").select(
        "doc_id",
        "text",
        F.col("spans").alias("base"),
        F.coalesce("terms", F.expr(f"CAST(array() AS {SPAN})")).alias("terms"),
        F.coalesce("removed", F.expr("CAST(array() AS array<string>)")).alias("removed"),
    )


def sanitised(found: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents with spans: base spans and generalised terms become a
    placeholder of their kind, removed terms go.  Of overlapping spans the first, then longest counts."""
    spans = F.array_sort(
        F.transform(F.concat("base", "terms"), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"), s["value"].alias("value")))
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gone = (s["kind"] == "term") & F.array_contains("removed", F.lower(s["value"]))
        mark = F.when(gone, "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        gap = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        moved = F.struct((-s["minus_end"]).alias("at"), F.concat(state["out"], gap, mark).alias("out"))
        return F.when(s["start"] >= state["at"], moved).otherwise(state)

    end = lambda x: F.concat(x["out"], F.col("text").substr(x["at"].cast("int") + 1, F.length("text")))
    return found.filter("text IS NOT NULL").select("doc_id", F.aggregate(spans, start, step, end).alias("text"))
