"""Batch enrichment with a user-supplied inference function.

`infer(list[str]) -> list[str]` runs inside Arrow batches, so only the prompt column leaves the
JVM. Its cost is bounded by filtering and de-duplicating in front of it; answers worth keeping
go to a table keyed by prompt digest, so a retried task or a later run does not ask again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork import lexicons as lx
from gleanwork.functions import predicates, responses, tags, text
from gleanwork.operators.joins import members, non_members
from gleanwork.operators.skew import equi_join
from gleanwork.session import staged
from gleanwork.sources import batches

Infer = Callable[[list[str]], Sequence[str | None]]
ANSWER = "response STRING, error STRING"


def answers(infer: Infer, prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """(answer, error) for each prompt. A batch that fails is asked again in halves, down to the prompts at fault, so the others keep
    their answers. An infer that always fails is called up to twice as often as there are prompts."""
    try:
        got = list(infer(prompts))
        if len(got) != len(prompts):
            raise ValueError(f"{len(got)} answers for {len(prompts)} prompts")
        return [(g, None) for g in got]
    except Exception as e:  # noqa: BLE001 - any failure of user code is recorded per row
        if len(prompts) == 1:
            return [(None, str(e))]
        half = len(prompts) // 2
        return answers(infer, prompts[:half]) + answers(infer, prompts[half:])


def ask(prompt: Column, infer: Infer, batch_size: int = 50, in_flight: int = 1) -> Column:
    """struct<response, error> per prompt. A failing prompt yields an error, not a failed batch or job.

    Rows with a null prompt are not asked and get nulls. Up to `in_flight` batches of a task are asked at once, by threads.
    """

    @F.pandas_udf(ANSWER)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as pool:
            for series in batches:
                asked = [(i, p) for i, p in enumerate(series) if p is not None]
                parts = [asked[start:start + batch_size] for start in range(0, len(asked), batch_size)]
                rows = [(None, None)] * len(series)
                for part, got in zip(parts, pool.map(lambda part: answers(infer, [p for _, p in part]), parts), strict=True):
                    for (i, _), answer in zip(part, got, strict=True):
                        rows[i] = answer
                yield pd.DataFrame(rows, columns=["response", "error"], dtype="object")

    return run.asNondeterministic()(prompt)


def enrich(
    df: DataFrame, prompt: Column, infer: Infer, batch_size: int = 50, in_flight: int = 1
) -> DataFrame:
    """Adds `response` and `error`."""
    asked = df.withColumn("__a", ask(prompt, infer, batch_size, in_flight))
    return asked.select(*df.columns, "__a.response", "__a.error")


def enrich_distinct(
    df: DataFrame, prompt: Column, infer: Infer, batch_size: int = 50, spread_by: Sequence[str] | None = None,
    store: str | None = None, in_flight: int = 1,
) -> DataFrame:
    """Ask once per distinct prompt and join the answers back by digest.

    `spread_by` names a row ordinal where one prompt may belong to a large share of the rows. With
    a `store`, answers are kept in that table and later runs do not ask again. Rows without a prompt
    match nothing.
    """
    if store is not None:
        return enrich_with_store(df, prompt, infer, store, batch_size, spread_by, in_flight)
    keyed = df.withColumn("__prompt", prompt)
    answered = _once(keyed).select(_digest().alias("__digest"), ask(F.col("__prompt"), infer, batch_size, in_flight).alias("__a"))
    keyed = keyed.withColumn("__digest", _digest())
    joined = equi_join(_spread_nulls(keyed, "__digest", df.columns), answered, ["__digest"], "left", "drop", spread_by)
    return joined.select(*df.columns, "__a.response", "__a.error")


def _digest() -> Column:
    """Of the prompt, as bytes: half as long as the text that a store keeps."""
    return F.unhex(F.sha2("__prompt", 256))


def _once(keyed: DataFrame) -> DataFrame:
    """The distinct prompts; their digests are made of them afterwards, so that they are not moved."""
    return keyed.select("__prompt").filter(F.col("__prompt").isNotNull()).distinct()


def _spread_nulls(keyed: DataFrame, digest: str, columns: Sequence[str]) -> DataFrame:
    """Rows without a prompt would share one join key; a hash of the row, no digest, spreads them."""
    kinds = dict(keyed.dtypes)
    own = F.xxhash64(*[c for c in columns if "map<" not in kinds[c] and "variant" not in kinds[c]])
    return keyed.withColumn(digest, F.coalesce(digest, F.unhex(F.hex(own))))


_STORE = "digest STRING, " + ANSWER


def enrich_with_store(
    df: DataFrame, prompt: Column, infer: Infer, store: str, batch_size: int = 50,
    spread_by: Sequence[str] | None = None, in_flight: int = 1,
) -> DataFrame:
    """As `enrich_distinct`, with answers kept in a table of batches at `store`, see `read_answers`.

    Prompts already answered there are not asked; new answers are written before they are used. Against a store that holds answers the digests
    of the prompts are compared first, and only prompts that are new are moved. The input is evaluated for each: the digests, the prompts to ask, if any, and
    the result.
    """
    spark = df.sparkSession
    keyed = df.withColumn("__prompt", prompt)
    digests = keyed.withColumn("__digest", _digest())
    before = batches.attempts(spark, store)
    new: DataFrame | None = _once(keyed)
    wanted = None
    if before:
        wanted = staged(digests.select("__digest").filter(F.col("__digest").isNotNull()).distinct(), "digests")
        good = batches.read_attempts(spark, store, list(before.values()), _STORE).filter("error IS NULL")
        fresh = staged(non_members(wanted, good.select(F.unhex("digest").alias("__digest")), "__digest"), "new-digests")
        new = None if fresh.isEmpty() else members(new.withColumn("__digest", _digest()), fresh, "__digest")
    if new is not None:
        asked = new.select(F.sha2("__prompt", 256).alias("digest"), ask(F.col("__prompt"), infer, batch_size, in_flight).alias("a"))
        batches.append_batch(asked.select("digest", "a.*"), store)
    kept = _last_answers(batches.read_batches(spark, store, _STORE))
    if wanted is not None:
        kept = kept.join(wanted, "__digest", "left_semi")
    joined = equi_join(_spread_nulls(digests, "__digest", df.columns), kept, ["__digest"], "left", "drop", spread_by)
    return joined.select(*df.columns, "response", "error")


def _last_answers(rows: DataFrame) -> DataFrame:
    """(__digest, response, error): one row per digest, as bytes."""
    found = rows.groupBy(F.unhex("digest").alias("__digest")).agg(F.max("response").alias("response"), F.max("error").alias("error"))
    return found.withColumn("error", F.when(F.col("response").isNull(), F.col("error")))


def read_answers(spark: SparkSession, store: str) -> DataFrame:
    """(digest, response, error): one row per prompt asked so far. A failed answer may be followed by a good one; a good answer wins."""
    return _last_answers(batches.read_batches(spark, store, _STORE)).select(F.lower(F.hex("__digest")).alias("digest"), "response", "error")


def keep_answered(df: DataFrame, column: str = "response") -> DataFrame:
    """Drop rows whose enrichment is missing or empty."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def translate(df: DataFrame, column: str, infer: Infer, store: str | None = None) -> DataFrame:
    """Translation batch. `infer` returns JSON with `response` and `total_duration`."""
    prompt = text.fill(lx.TRANSLATE_PROMPT, text=F.col(column))
    v = F.try_parse_json(F.col("response"))
    asked = enrich_distinct(df, prompt, infer, store=store)
    out = asked.select(
        F.col(column).alias("original"),
        text.lstrip(F.try_variant_get(v, "$.response", "string")).alias("translation"),
        F.try_variant_get(v, "$.total_duration", "bigint").alias("duration"),
    )
    return keep_answered(out, "translation")


def describe_images(images: DataFrame, infer: Infer, batch_size: int = 4, store: str | None = None) -> DataFrame:
    """path, description. The prompt is the base64 payload; failures become error texts."""
    asked = enrich_distinct(images, F.col("payload"), infer, batch_size, store=store)
    return asked.select(
        "path",
        F.when(F.col("error").isNotNull(), F.concat(F.lit("Error: "), F.col("error")))
        .when(F.coalesce(F.col("response"), F.lit("")) == "", "Error: No content received")
        .otherwise(text.strip(F.col("response")))
        .alias("description"),
    )


def widen(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select(*[c for c in df.columns if c != column], f"{column}.*")


def two_pass_verdict(
    df: DataFrame, first: Column, evidence: DataFrame, key: str,
    suffix: str = lx.CHECKED_SUFFIX,
) -> DataFrame:
    """Positive first verdicts stand; negative ones are settled by the evidence table.

    `first` is struct<relevant, reason>; `evidence` has one row (key, supports, evidence) per
    key. Positive rows never match it, and negative rows without evidence stay unverified. The
    first verdict is computed once, so it may come from a model.
    """
    judged = df.withColumn("__v", first)
    doubted = ~F.coalesce(F.col("__v.relevant"), F.lit(False))
    known = evidence.select(F.col(key).alias("__key"), "supports", "evidence")
    joined = judged.join(known, (F.col(key) == F.col("__key")) & doubted, "left")
    checked = F.col("supports").isNotNull()
    reason = F.col("__v.reason")
    return joined.select(
        *df.columns,
        (~doubted | F.coalesce(F.col("supports"), F.lit(False))).alias("relevant"),
        F.when(F.col("supports"), F.col("evidence"))
        .when(checked, F.concat(F.coalesce(reason, F.lit("")), F.lit(suffix)))
        .otherwise(reason).alias("reason"),
        checked.alias("verified"),
    )


@dataclass(frozen=True)
class UseCase:
    """A use to curate: its tag, the keywords that suggest it, and how they match."""

    name: str
    target_tag: str
    keywords: tuple[str, ...]
    whole_word: bool = True
    tag_column: str = "use_aggregated"
    text_column: str = "tool_description"
    answer_flag: str = "relevant"

    def suggests(self, column: str) -> Column:
        match = predicates.any_word if self.whole_word else predicates.any_keyword
        return match(F.col(column), self.keywords)

    def prompt(self) -> Column:
        return text.fill(lx.USE_PROMPT, use=F.lit(self.name), desc=F.col(self.text_column))


def curate(
    base: DataFrame, case: UseCase, key: str, judge: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """(cohort with verdict and repaired tags, candidates found only by description).

    `judge` adds `relevant` and `reason` to the cohort; see `judged_by` for the two usual ways.
    """
    cohort = base.filter(case.suggests(case.tag_column))
    candidates = non_members(base.filter(case.suggests(case.text_column)), cohort, key)
    judged = judge(cohort)
    repaired = judged.withColumn(
        case.tag_column, tags.upsert_tag(F.col(case.tag_column), case.target_tag, F.col("relevant"))
    )
    return repaired, candidates


def judged_by(case: UseCase, infer: Infer | None = None, store: str | None = None) -> Callable[[DataFrame], DataFrame]:
    """By the model, where an invalid response fails the job; without one by the keywords."""

    def by_rules(cohort: DataFrame) -> DataFrame:
        hit = case.suggests(case.text_column)
        reason = F.when(hit, F.lit("keyword in description"))
        return cohort.withColumn("relevant", hit).withColumn("reason", reason)

    def by_model(cohort: DataFrame) -> DataFrame:
        asked = enrich_distinct(cohort, case.prompt(), infer, store=store)
        parsed = responses.require_valid(
            responses.parse_use_check(F.col("response"), case.answer_flag), F.col("response")
        )
        return widen(asked.withColumn("__r", parsed).drop("response", "error"), "__r")

    return by_rules if infer is None else by_model


def flag_use(df: DataFrame, flag: str, tag_column: str, phrase: str) -> DataFrame:
    """Rows flagged for a use; the flag is inferred from the tags if the column is missing."""
    if flag not in df.columns:
        df = df.withColumn(flag, predicates.any_keyword(F.col(tag_column), [phrase]))
    return df.filter(F.col(flag))


def payload(df: DataFrame, order: str, k: int = 10) -> DataFrame:
    """The first k rows as one JSON array of records."""
    top = df.orderBy(order).limit(k)
    record = F.struct(*[F.col(c) for c in df.columns])
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("__o"), record.alias("__r"))))
    return top.agg(F.to_json(F.transform(listed, lambda x: x["__r"])).alias("payload"))
