"""Benchmark decontamination by template canonicalisation.

Words become tokens: numbers, names (capitalised inside a sentence) and units (after a number) become
typed placeholders and keep their value as a *slot*, all others are lower case without punctuation at
their ends.  A number glued to letters ('5kg', '5-year') is two tokens.  A second template has names also at the start
of sentences and lines, function words apart, and number words as numbers.  Every window of eight tokens of the benchmark is hashed, as a template and as it is written
(a passage in other capitals has other names, but the same words); a Bloom filter of a fixed number
of bits, sent to all tasks, passes over the documents' windows that no item has.  The windows left are
hash-joined with the benchmark's.  Along one alignment of document and item each number and unit of the item must
stand for one value of the document, so a question whose numbers and names were exchanged is found, and a chance mix
of values is not; two numbers may have become equal.  Names must map one to one, and windows with names that do not are
left out.

A document leaks an item when at least 30 % of the item's windows match, or 13 windows.  Items of four to
seven tokens are one window; shorter ones, and templates with fewer than four plain words, say too
little and are not searched for.  Null and empty texts match nothing; null ids stay null.  Rows that repeat an
id are judged each by its own text.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.llm.common import MASK, mixed, row_key, store, text_of

WIDTH, LEAST = 8, 4
BITS = 1 << 23
_PART = 32_768
#: Words that name a unit after a number.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound pounds "
    "ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days "
    "week weeks month months year years cent cents dollar dollars euro euros percent degree degrees "
    "mph kmh watt watts volt volts".split()
)
_FUNCTION = frozenset(
    "a an the this that these those he she it they we you i his her its their our your my him them us me who whom whose "
    "which what when where why how if then else so but and or nor yet for of in on at by to from with without within "
    "into onto over under after before during until since while because although though as than about above below "
    "between among through across against toward towards upon per via is are was were be been being am has have had "
    "does do did can could should would shall must might not no yes there here each every all any some both either "
    "neither none many much more most few less least several such other another same also only just even still again "
    "now once first last next finally later however therefore thus hence let given suppose assume find".split()
)
_COUNTS = {
    word: str(n)
    for n, word in enumerate(
        "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
        "seventeen eighteen nineteen".split()
    )
}
_TENS = {w: n * 10 for n, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
_COUNTS |= {w: str(n) for w, n in _TENS.items()} | {
    f"{w}-{d}": str(n + int(_COUNTS[d])) for w, n in _TENS.items() for d in list(_COUNTS)[1:10]
}
_COUNTS |= {"dozen": "12", "hundred": "100", "thousand": "1000", "million": "1000000", "billion": "1000000000"}
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(?:[%°]|st|nd|rd|th)?", re.I)
#: A number and the letters that follow it, or that a hyphen joins to it; letters may hold further hyphens and slashes.
_GLUED = re.compile(r"([\W_]*\d[\d.,:/]*)(-?[^\W\d_]+(?:[-/][^\W\d_]+)*[\W_]*)")
_BREAK = "\ue000"  # stands for a line break among the words
CAPITAL, STOP, NUMBER, UNIT, COUNTED, FUNCTION, MARKS = 1, 2, 4, 8, 16, 32, 63
GLUED = NUMBER | UNIT  # no word is both
#: Characters of text that are cut into windows at a time; a longer text is a piece of its own.
_PIECE = 1 << 20


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word) & (MASK ^ MARKS) or MARKS + 1


def _core(word: str) -> str:
    """``word`` without what is no letter or digit at its ends."""
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


_PLACEHOLDERS = [_hash(f"<{kind}>") for kind in ("number", "name", "unit")]


class _Words(dict):
    """Word as written to token hash (high 58 bits; 0: no token) and marks (low 6 bits)."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        plain = word.isalpha()
        core = word if plain else _core(word)
        marks = 0 if plain or not (word == _BREAK or word.rstrip("\"')]»”").endswith((".", "!", "?", ":"))) else STOP
        if not core or word == _BREAK:
            value = marks
        elif plain or core.isalpha():
            value = self._letters(core) | marks
        elif _NUMBER.fullmatch(core):
            value = _hash(core) | marks | NUMBER
        elif core[-1].isalpha() and _GLUED.fullmatch(word):
            value = MARKS + 1 | marks | GLUED
        else:
            value = self._letters(core) | marks
        self[word] = value
        return value

    @staticmethod
    def _letters(core: str) -> int:
        low = core.lower()
        marks = UNIT * (low in UNITS) | COUNTED * (low in _COUNTS) | FUNCTION * (low in _FUNCTION)
        if low != core:
            marks |= CAPITAL * (core[0].isupper() and core[1:] != core[1:].upper())
        return _hash(low) | marks


@functools.lru_cache(maxsize=1)
def _known() -> _Words:
    return _Words()


def tokens(text: str) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Token hashes as written, their kinds (0 plain, 1 number, 2 name, 3 unit), all words as written,
    and the word number of each token."""
    value, kind, _, _, found, real = both([text])
    return value, kind, found, real


def both(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray]:
    """Of several texts at once: ``tokens`` with the kinds of the second template after the kinds of the first, then
    the number of the text of each token."""
    split = [text.replace("\n", f" {_BREAK} ").split() for text in texts]
    of = np.repeat(np.arange(len(texts)), [len(x) for x in split])
    found = list(chain.from_iterable(split))
    known = _known()
    value = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    marks = (value & np.uint64(MARKS)).astype(np.uint8)
    glued = (marks & GLUED) == GLUED
    if glued.any():
        of = np.repeat(of, 1 + glued)
        found = [p for w, g in zip(found, glued) for p in (_GLUED.fullmatch(w).groups() if g else (w,))]
        value = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        marks = (value & np.uint64(MARKS)).astype(np.uint8)
    value &= ~np.uint64(MARKS)
    real = np.flatnonzero(value)
    of = of[real]
    first = np.r_[True, of[1:] != of[:-1]][: len(real)]
    # a token starts a sentence where a word since the token before, that token included, ends one
    stops = np.r_[0, np.cumsum((marks & STOP) > 0)]
    starts = first | np.r_[True, stops[real[1:]] > stops[real[:-1]]][: len(real)]
    marks, value = marks[real], value[real]
    after = lambda there: np.r_[False, there[:-1]][: len(real)] & ~first
    number, counted = (marks & NUMBER) > 0, (marks & COUNTED) > 0
    unit = ((marks & UNIT) > 0) & after(number)
    capital = (marks & CAPITAL) > 0
    name = capital & ~starts & ~unit
    numbers = number | counted
    units = ((marks & UNIT) > 0) & after(numbers) & ~counted
    names = capital & ~units & ~counted & (~starts | ((marks & FUNCTION) == 0))
    kind = (number * 1 + name * 2 + unit * 3).astype(np.uint8)
    return value, kind, (numbers * 1 + names * 2 + units * 3).astype(np.uint8), of, found, real


def windows(
    value: np.ndarray, kind: np.ndarray, second: np.ndarray, of: np.ndarray, width: int
) -> list[tuple[np.ndarray | None, np.ndarray, np.ndarray]]:
    """(kinds, places, hashes) of the windows of ``width`` tokens of one text: as written (no kinds) all of them, as
    templates those with a slot and enough plain words, of the second template where it differs."""
    n = len(value) - width + 1
    if n <= 0:
        return []
    inside = lambda there: (c := np.r_[0, np.cumsum(there, dtype=np.int32)])[width:] - c[:-width]
    one = of[:n] == of[width - 1 :]
    at = np.flatnonzero(one)
    out = [(None, at, _rolled(value, width, width)[at])]
    for kinds, wanted in ((kind, one), (second, one & (inside(kind != second) > 0))):
        slots = inside(kinds > 0)
        at = np.flatnonzero((slots > 0) & (slots <= width - LEAST) & wanted)
        if len(at):
            template = value.copy()
            for k, placeholder in enumerate(_PLACEHOLDERS, 1):
                template[kinds == k] = np.uint64(placeholder)
            out.append((kinds, at, _rolled(template, width, width + 100)[at]))
    return out


def _rolled(value: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Polynomial hash of each run of ``width`` values, put together from runs of powers of two."""
    n = len(value) - width + 1
    factor = [0x9E3779B97F4A7C15]
    run, size, at = value, 1, 0
    out = None
    while True:
        if width & size:
            part = run[width - at - size : width - at - size + n]  # the last values first
            out = part if out is None else out + part * np.uint64(pow(factor[0], at, 1 << 64))
            at += size
        if size * 2 > width:
            break
        run = run[:-size] * np.uint64(pow(factor[0], size, 1 << 64)) + run[size:]
        size *= 2
    return mixed(out + np.uint64(seed * pow(factor[0], width, 1 << 64) & MASK))


def _slots(kind: np.ndarray, found: list[str], real: np.ndarray, at: int, width: int) -> list[str]:
    """Slots of a window: kind and value; number words are their digits."""
    slots = [(kind[k], _core(found[real[k]]).lower()) for k in range(at, at + width) if kind[k]]
    return [f"{k} {_COUNTS.get(word, word) if k == 1 else word}" for k, word in slots]


def pieces(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``_PIECE`` characters with the number of their first."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= _PIECE:
            yield start, texts[start : k + 1]
            start, size = k + 1, 0
    if start < len(texts):
        yield start, texts[start:]


WINDOW = "hash long, place int, written boolean, slots array<string>"


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(hash, width, item_id, item_key, item_place, item_slots, item_windows) of all items."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            rows = []
            for item_id, key, text in zip(df["item_id"].astype("Int64"), df["item_key"], df["text"]):
                value, kind, second, of, found, real = both([text])
                width = min(WIDTH, len(value))
                if width < LEAST:
                    continue
                total = len(value) - width + 1
                for kinds, at, hashes in windows(value, kind, second, of, width):
                    for a, h in zip(at, hashes.astype(np.int64)):
                        slots = [] if kinds is None else _slots(kinds, found, real, a, width)
                        rows.append((h, width, item_id, key, a, slots, total))
            out = pd.DataFrame(
                rows, columns=["hash", "width", "item_id", "item_key", "item_place", "item_slots", "item_windows"]
            )
            out["item_id"] = out["item_id"].astype("Int64")
            yield out

    kinds = "hash long, width int, item_id long, item_key string, item_place int, item_slots array<string>, item_windows int"
    return (
        benchmark.select("item_id", text_of().alias("text"), row_key("item_id").alias("item_key"))
        .dropDuplicates(["item_key"])
        .mapInPandas(cut, kinds)
    )


def bloom(hashes: DataFrame) -> np.ndarray:
    """The filter's bits, two per hash, one per byte; at most 256 rows of 4 kB come to the driver."""
    slot = F.explode(F.array(F.pmod("hash", F.lit(BITS)), F.pmod(F.shiftright("hash", 24), F.lit(BITS))))
    parts = (
        hashes.select(slot.alias("slot"))
        .groupBy((F.col("slot") / _PART).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg(F.col("slot") % _PART).alias("bits"))
        .collect()
    )
    out = np.zeros(BITS // 8, np.uint8)
    for r in parts:
        out[r["part"] * _PART // 8 : (r["part"] + 1) * _PART // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _held(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    signed = hashes.astype(np.int64)
    yes = np.ones(len(signed), bool)
    for slot in (signed % BITS, (signed >> 24) % BITS):
        yes &= (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
    return yes


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.3, enough: int = 13) -> DataFrame:
    """One row per leaked item of a document: doc_id, row_key, item_id, matched, item_windows, exact.

    ``exact`` is false where slots differ: the question was re-parameterised.
    """
    spark: SparkSession = docs.sparkSession
    items = store(item_windows(benchmark), "decontamination-items")
    bits = spark.sparkContext.broadcast(bloom(items))  # 1 MB
    widths = [r["width"] for r in items.select("width").distinct().collect()]  # at most five

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            rows = []
            keys, ids = df["row_key"].to_list(), df["doc_id"].astype("Int64").to_list()
            for first, texts in pieces(df["text"].to_list()):
                value, kind, second, of, found, real = both(texts)
                begins = np.searchsorted(of, np.arange(len(texts)))
                for width in widths:
                    for kinds, at, hashes in windows(value, kind, second, of, width):
                        hit = np.flatnonzero(_held(bits.value, hashes))
                        for a, h in zip(at[hit], hashes[hit].astype(np.int64)):
                            k = first + of[a]
                            slots = [] if kinds is None else _slots(kinds, found, real, a, width)
                            rows.append((keys[k], ids[k], h, a - begins[of[a]], kinds is None, slots))
            out = pd.DataFrame(rows, columns=["row_key", "doc_id", "hash", "place", "written", "slots"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    hits = docs.select("doc_id", text_of().alias("text"), row_key().alias("row_key")).mapInPandas(
        search, f"row_key string, doc_id long, {WINDOW}"
    )
    window = F.struct("item_place", F.arrays_zip("item_slots", "slots").alias("pairs"))
    value = F.filter("pairs", lambda p: ~p["item_slots"].startswith("2 "))
    name = F.filter("pairs", lambda p: p["item_slots"].startswith("2 "))
    # names of which one side has another partner too
    torn = lambda p: F.exists("names", lambda q: (p["item_slots"] == q["item_slots"]) != (p["slots"] == q["slots"]))
    aligned = (
        hits.join(items, "hash")
        .groupBy("row_key", "doc_id", "item_key", "item_id", "item_windows", "written", (F.col("place") - F.col("item_place")).alias("shift"))
        .agg(F.collect_set(window).alias("windows"))
        .withColumn("pairs", F.array_distinct(F.flatten("windows.pairs")))
        .withColumn("values", value)
        .withColumn("names", name)
        .filter(F.size("values") == F.size(F.array_distinct("values.item_slots")))
        .withColumn("torn", F.filter("names", torn))
        .withColumn("windows", F.filter("windows", lambda w: ~F.arrays_overlap(w["pairs"], "torn")))
        .filter(F.size("windows") > 0)
        .withColumn("places", F.array_distinct("windows.item_place"))
        .withColumn("same", F.forall(F.flatten("windows.pairs"), lambda p: p["item_slots"] == p["slots"]))
    )
    matched = F.size(F.array_distinct(F.flatten(F.collect_list("places"))))
    return (
        aligned.groupBy("row_key", "doc_id", "item_key", "item_id", "item_windows")
        .agg(matched.alias("matched"), F.bool_and("same").alias("exact"))
        .filter(F.col("matched") >= F.least(F.lit(enough), F.ceil(F.col("item_windows") * share)))
        .select("doc_id", "row_key", "item_id", "matched", "item_windows", "exact")
    )
