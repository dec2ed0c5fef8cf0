"""Slot for a user-supplied function per row, with retries and error isolation."""

import json
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediamart.operators.text import FENCED, RETRY_ANSWER, RETRY_ERROR, RETRY_REQUEST
from mediamart.sources.tables import Tables


class Transient(Exception):
    """The call may succeed when it is made again."""


class Unavailable(Exception):
    """This item cannot be had; the others can.  ``attempts`` is the number of calls it took to know."""

    attempts = 1


def _refuse(word: str) -> None:
    """NaN and the infinities are not JSON."""
    raise json.JSONDecodeError(f"{word} is not JSON", word, 0)


def answer_text(text: str) -> str:
    """The JSON text of an answer, by the rule of ``strip_fences``."""
    found = re.search(FENCED, text)
    return (found.group(1) if found else text).strip()


def ask(
    fn: Callable[[str], str], prompt: str, max_attempts: int, clean: Callable[[str], str]
) -> tuple[str | None, int]:
    """The first valid JSON answer and the number of calls made; None after the last attempt."""
    current = prompt
    for attempt in range(1, max_attempts + 1):
        try:
            answer = clean(fn(current))
            json.loads(answer, parse_constant=_refuse)
            return answer, attempt
        except Transient:
            continue
        except Unavailable as error:
            error.attempts = attempt
            raise
        except json.JSONDecodeError as error:
            current = f"{prompt}{RETRY_ERROR}{error}{RETRY_ANSWER}{answer}{RETRY_REQUEST}"
    return None, max_attempts


def enrich(
    df: DataFrame,
    make_fn: Callable[[], Callable[[str], str]],
    key: str,
    prompt: str,
    max_attempts: int = 2,
    clean: Callable[[str], str] = answer_text,
    side_by_side: int = 1,
) -> DataFrame:
    """Ask for every row of ``df(key, prompt)`` and return ``(key, result, attempts, error)``.

    A task makes up to ``side_by_side`` calls at a time, which pays where a call mostly waits; the function must
    then be safe to be called from several threads.

    ``make_fn`` runs once per task and returns the function to call, so a model or client is
    loaded there and not per row.  An ``Unavailable`` item gives NULL and its error class; any
    other error fails the query.  Rows are handled where they are, without a shuffle.
    """
    schema = T.StructType(
        [
            df.schema[key],
            T.StructField("result", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
            T.StructField("error", T.StringType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make_fn()

        def one(k: object, text: str) -> tuple:
            try:
                result, attempts = ask(fn, text, max_attempts, clean)
                return k, result, attempts, None if result is not None else "NoValidAnswer"
            except Unavailable as error:
                return k, None, error.attempts, type(error).__name__

        with ThreadPoolExecutor(max(1, side_by_side)) as pool:
            for batch in batches:
                asked = pool.map if side_by_side > 1 else map
                yield pd.DataFrame(list(asked(one, batch[key], batch[prompt])), columns=schema.names)

    return df.select(key, prompt).mapInPandas(run, schema)


def split_errors(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable results, and the skipped items with their error class."""
    return results.filter(F.col("error").isNull()), results.filter(F.col("error").isNotNull())


def enrich_stored(
    tables: Tables,
    label: str,
    df: DataFrame,
    make_fn: Callable[[], Callable[[str], str]],
    key: str,
    prompt: str,
    budget: int | None = None,
    round_calls: int = 100_000,
    max_attempts: int = 2,
    clean: Callable[[str], str] = answer_text,
    side_by_side: int = 8,
) -> DataFrame:
    """As ``enrich``, with answers that outlive a run: all answers stored for (key, prompt) under ``label``.

    What has been asked before is not asked again.  The rest is asked in rounds of about ``round_calls`` rows, each a job
    that spreads over all executors and whose answers are stored when it ends; so a run that dies loses the answers of one
    round, and a lost task those of its own rows.  ``budget`` is the number of calls that all tasks together may make in
    this run: a round is cut to what is left even if every row takes all its attempts, and rows beyond it wait for the
    next run.  The result holds the answered rows of ``df``.
    """
    name = f"process_answers_{label}"
    wanted = df.select(key, prompt, F.sha2(prompt, 256).alias("asked"))
    same = [key, "asked"]

    def stored() -> DataFrame | None:
        return tables.read(name)

    def pending() -> DataFrame:
        return wanted if stored() is None else wanted.join(stored().select(*same), same, "left_anti")

    todo = tables.stage(f"pending_{label}", pending().dropDuplicates(same))
    rounds = max(1, -(-todo.count() // round_calls))
    left = budget
    for turn in range(rounds):
        part = todo.filter(F.pmod(F.xxhash64(*same), F.lit(rounds)) == turn)
        if left is not None:
            part = part.limit(left // max_attempts)
        answers = enrich(part.withColumn("_both", F.struct(*same)), make_fn, "_both", prompt, max_attempts, clean, side_by_side)
        before = tables.last_number(name)
        tables.append(name, answers.select("_both.*", "result", "attempts", "error"))
        if left is not None:
            spent = tables.read_after(name, before).agg(F.coalesce(F.sum("attempts"), F.lit(0))).first()[0]
            left -= spent
            if left < max_attempts:
                break
    tables.clear(f"pending_{label}")
    return stored().join(wanted.select(*same).distinct(), same, "left_semi").drop("asked")


def explode_with(df: DataFrame, make_fn: Callable[[], Callable[[str], list[dict]]], key: str, prompt: str, fields: str) -> DataFrame:
    """(key, fields ..., error): the rows that a user's function returns for each ``prompt``, a lateral join with a table function.

    ``make_fn`` runs once per task and returns a function from text to records with the names in ``fields`` (``name type, ...``).
    An ``Unavailable`` item has one row with its error class and NULL fields; no records, no row; any other error
    fails the query.
    """
    schema = T.StructType.fromDDL(fields).add("error", "string")
    names = schema.names

    class Rows:
        def __init__(self) -> None:
            self.fn = make_fn()

        def eval(self, text: str | None) -> Iterator[tuple]:
            try:
                for record in self.fn(text):
                    yield tuple(record.get(n) for n in names[:-1]) + (None,)
            except Unavailable as error:
                yield (None,) * (len(names) - 1) + (type(error).__name__,)

    function = F.udtf(Rows, returnType=schema, useArrow=True)
    return df.select(key, prompt).lateralJoin(function(F.col(prompt).outer())).select(key, *names)
