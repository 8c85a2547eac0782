"""Apply a user's text function to every row, with status, error and bounded retry."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import presets
from tidemark.operators import skew
from tidemark.streaming.segments import folders, write_folder

REPLY = "array<struct<type:string,text:string>>"


class Throttled(Exception):
    """Raise from the text function to ask for a retry after a pause."""


def _throttled(error: Exception) -> bool:
    status = getattr(error, "status_code", getattr(error, "status", None))
    return isinstance(error, Throttled) or status == 429


def _ask(fn: Callable[[str], str], text: str, retries: int, backoff: float) -> tuple[str | None, str | None]:
    pause = backoff
    error: Exception | None = None
    for attempt in range(retries):
        try:
            return fn(text), None
        except Exception as caught:  # noqa: BLE001 - one bad row must not end the job
            error = caught
            if not _throttled(caught):
                break
            if attempt + 1 < retries:
                time.sleep(pause)
                pause *= 2
    return None, str(error) or type(error).__name__


def _is_structured(reply: Column) -> Column:
    return F.substring(F.trim(reply), 1, 1).isin("[", "{")


def reply_text(reply: Column) -> Column:
    """Text of the first ``text`` block of a JSON reply; a plain reply is its own text."""
    blocks = F.filter(F.from_json(reply, REPLY), lambda b: b["type"] == "text")
    return F.when(_is_structured(reply), F.trim(F.get(blocks, F.lit(0))["text"])).otherwise(F.trim(reply))


def unreadable(reply: Column) -> Column:
    return _is_structured(reply) & F.try_parse_json(reply).isNull()


def reply_status(text: Column, broken: Column, error: Column) -> Column:
    return (
        F.when(error.isNotNull(), "FAILED")
        .when(broken, "PARSE_ERROR")
        .when(F.coalesce(F.length(text), F.lit(0)) == 0, "EMPTY")
        .otherwise("SUCCESS")
    )


def map_text(
    df: DataFrame,
    prompt_col: str,
    fn: Callable[[str], str],
    retries: int = presets.RETRIES,
    backoff: float = presets.BACKOFF_SECONDS,
) -> DataFrame:
    """Add ``reply_text``, ``generation_status`` and ``error_message``.

    Runs on the executors in Arrow batches; only the prompt goes to Python, the other columns
    stay where they are. ``fn`` and what it holds are shipped once per task, and ``fn`` may be
    called again for a row if Spark reruns a task.
    """

    @F.pandas_udf("reply string, error string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            answers = [_ask(fn, text, retries, backoff) for text in texts]
            yield pd.DataFrame(answers, columns=["reply", "error"], dtype=object)

    # a model need not repeat itself: keep Spark from asking twice for the same row
    raw = df.withColumn("_asked", ask.asNondeterministic()(F.col(prompt_col)))
    return _read(raw.withColumns({"_reply": F.col("_asked.reply"), "_error": F.col("_asked.error")}).drop("_asked"))


def _read(raw: DataFrame) -> DataFrame:
    """``_reply`` and ``_error`` to reply_text, generation_status and error_message."""
    reply = F.col("_reply")
    read = raw.withColumns({"_text": reply_text(reply), "_broken": unreadable(reply)})
    text, status = F.col("_text"), F.col("generation_status")
    return (
        read.withColumn("generation_status", reply_status(text, F.col("_broken"), F.col("_error")))
        .withColumns(
            {
                "reply_text": F.when(status == "SUCCESS", text),
                "error_message": F.coalesce(
                    "_error", F.when(status == "PARSE_ERROR", F.lit("reply is not valid JSON"))
                ),
            }
        )
        .drop("_reply", "_error", "_text", "_broken")
    )


class Asker:
    """Asks in batches of prompts, with one pause for the whole task.

    ``fn`` takes a list of texts and gives a list of replies, an exception in place of a reply
    that failed; it may raise instead for all of them. After a throttled call the task waits,
    longer each time, and every later batch keeps to that pause until calls succeed again.
    """

    def __init__(self, fn: Callable[[list[str]], list], batch: int, retries: int, backoff: float):
        self.fn, self.batch, self.retries, self.backoff = fn, batch, retries, backoff
        self.pause = 0.0

    def _call(self, texts: list[str]) -> list:
        if self.pause:
            time.sleep(self.pause)
        try:
            answers = list(self.fn(texts))
        except Exception as caught:  # noqa: BLE001 - one bad batch must not end the job
            answers = [caught] * len(texts)
        if len(answers) != len(texts):
            answers = [ValueError(f"{len(answers)} replies to {len(texts)} prompts")] * len(texts)
        if any(_throttled(a) for a in answers if isinstance(a, Exception)):
            self.pause = max(self.backoff, 2 * self.pause)
        else:
            self.pause /= 2
            if self.pause < self.backoff:
                self.pause = 0.0
        return answers

    def ask(self, texts: list[str]) -> list[tuple[str | None, str | None]]:
        out: list = []
        for first in range(0, len(texts), self.batch):
            part = texts[first : first + self.batch]
            answers: list = [None] * len(part)
            left = list(range(len(part)))
            for _ in range(self.retries):
                for i, answer in zip(left, self._call([part[i] for i in left]), strict=True):
                    answers[i] = answer
                left = [i for i in left if isinstance(answers[i], Exception) and _throttled(answers[i])]
                if not left:
                    break
            out += [(None, str(a) or type(a).__name__) if isinstance(a, Exception) else (a, None) for a in answers]
        return out


ANSWERS = "prompt_hash binary, reply string, error string"


def answers(spark: SparkSession, path: str) -> DataFrame:
    """Answers kept so far, one per prompt; a later good one replaces a failure."""
    names = folders(spark, path)
    if not any(n.startswith("part=") for n in names):
        return spark.createDataFrame([], ANSWERS)
    rows = spark.read.schema(ANSWERS).parquet(f"{path}/part=*")
    best = F.min_by(F.struct("reply", "error"), F.struct(F.col("error").isNotNull(), F.col("reply"), F.col("error")))
    return rows.groupBy("prompt_hash").agg(best.alias("a")).select("prompt_hash", "a.reply", "a.error")


def map_text_kept(
    df: DataFrame,
    prompt_col: str,
    fn: Callable[[list[str]], list],
    path: str,
    batch: int = 32,
    slices: int = 16,
    retries: int = presets.RETRIES,
    backoff: float = presets.BACKOFF_SECONDS,
) -> DataFrame:
    """As ``map_text``, with answers kept under ``path`` by the prompt's hash.

    Equal prompts are asked once. Prompts go out in ``slices`` of the hash space; each slice's
    answers appear as one folder when it is done, so a run that failed goes on with the slices
    that are missing, and a second run asks nothing but what failed or is new. A NULL prompt
    isn't asked: it has the status EMPTY.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_hash", F.unhex(F.sha2(F.col(prompt_col), 256)))
    asked = keyed.filter(F.col("_hash").isNotNull()).groupBy(F.col("_hash").alias("prompt_hash")).agg(F.first(prompt_col).alias("prompt"))
    known = answers(spark, path).filter("error IS NULL").select("prompt_hash")
    todo = asked.join(known, "prompt_hash", "left_anti")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asker = Asker(fn, batch, retries, backoff)
        for frame in frames:
            replies = asker.ask(frame["prompt"].tolist())
            found = pd.DataFrame(replies, columns=["reply", "error"], dtype=object)
            yield pd.DataFrame({"prompt_hash": frame["prompt_hash"].to_numpy(), "reply": found["reply"].to_numpy(), "error": found["error"].to_numpy()})

    share = F.pmod(F.xxhash64("prompt_hash"), F.lit(slices))
    run = uuid.uuid4().hex
    for n in todo.groupBy(share.alias("n")).count().orderBy("n").collect():      # a row per slice
        part = todo.filter(share == n["n"]).repartition("prompt_hash").mapInPandas(ask, ANSWERS)
        write_folder(part, path, f"part={run}-{n['n']}")
    replies = answers(spark, path).select(F.col("prompt_hash").alias("_hash"), F.col("reply").alias("_reply"), F.col("error").alias("_error"))
    return _read(skew.left_join_unique(keyed, replies, ["_hash"])).drop("_hash")
