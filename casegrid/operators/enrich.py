"""Cache-aware batch enrichment with a pluggable classifier.

Set-based re-expression of a per-row loop (hash -> cache lookup -> classify
miss -> store -> upsert):

1. clean the narrative fields, hash them (content key), and store the narrow
   ``(incident_id, content_hash)`` table once;
2. one representative row per distinct hash (smallest id) and its number of
   rows, map-side combined and stored once, and anti-joined against the cache
   for this prompt version: the misses;
3. only then fetch the text, once for all batches: where most texts are misses
   by an aggregate per hash, so that a text that many rows share leaves a task
   once and no other text moves twice, else for the misses' rows alone;
4. classify them (native rules, or an external model through
   ``mapInPandas``), validate the JSON replies natively, and append the
   answers to a table batch by batch, so that a run that breaks off has lost
   one batch of calls at most;
5. join the answers back to every row (a text that many rows share is dealt
   out by salt), derive a per-row status, and store that once;
6. upsert the enrichment table by id and insert new answers into the cache.

Counter semantics: within one run a second row with an already answered text
is a cache hit, so ``from_cache = succeeded - newly classified texts``.  A
text whose reply is rejected fails for all of its rows (one attempt per
distinct text).
"""

from __future__ import annotations

import queue
import random
import threading
import time
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.functions.clean import clean_text
from casegrid.functions.keys import content_hash
from casegrid.functions.prompt import INSTRUCTIONS, NARRATIVE_FIELDS, PROMPT_VERSION, render_prompt
from casegrid.functions.reply import CLASSIFICATION_FIELDS, reply_json, with_validated
from casegrid.operators.joins import balanced_join, hot_keys, salted_join
from casegrid.operators.merge import insert_if_absent, upsert_by_key
from casegrid.session import materialise, scratch_path, shuffles_freed
from casegrid.sources.tables import read_or_empty

CACHE_SCHEMA = T.StructType([
    T.StructField("content_hash", T.StringType(), False),
    T.StructField("prompt_version", T.StringType(), False),
    T.StructField("contributing_factor", T.StringType()),
    T.StructField("severity_tier", T.StringType()),
    T.StructField("event_category", T.StringType()),
    T.StructField("recurrence_prevention", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("cached_at", T.TimestampNTZType()),
])

ENRICHMENT_SCHEMA = T.StructType([
    T.StructField("incident_id", T.StringType(), False),
    T.StructField("contributing_factor", T.StringType()),
    T.StructField("severity_tier", T.StringType()),
    T.StructField("event_category", T.StringType()),
    T.StructField("recurrence_prevention", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("prompt_version", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("enriched_at", T.TimestampNTZType()),
])

STATUS_CLASSIFIED = "classified"
STATUS_CACHED = "cached"
STATUS_FAILED = "failed"

# A classifier maps a request frame (content_hash, prompt, narrative_text, ...)
# to the same frame plus a ``reply`` string column (JSON, or null on failure).
Classifier = Callable[[DataFrame], DataFrame]

# ---------------------------------------------------------------------------
# Native keyword-rule classifier (no model needed; runs in whole-stage codegen)
# ---------------------------------------------------------------------------

# Fixed values of the rule classifier: category, keywords (matched as whole
# words in the lower-cased whole text), cause phrase, what to do about it.
# The first matching category wins.
RULES: tuple[tuple[str, tuple[str, ...], str, str], ...] = (
    ("fall_slip_trip", ("fell", "fall", "falls", "slipped", "slip", "tripped", "trip", "ladder"),
     "unsafe walking surface", "keep floors dry and inspect ladders every week"),
    ("struck_by_or_against", ("struck", "hit", "bumped", "collided"),
     "object in motion", "keep people out of the path of loads"),
    ("contact_with_equipment", ("caught", "machine", "press", "conveyor", "blade", "saw"),
     "open point of operation", "lock out the drive before hands go near it"),
    ("overexertion_bodily_reaction", ("lifting", "lifted", "strain", "strained", "twisted", "carrying"),
     "heavy or awkward load", "use a hoist or a second person for such loads"),
    ("exposure_harmful_substance", ("chemical", "fumes", "exposed", "exposure", "burn", "heat"),
     "contact with an agent", "vent the area and wear rated gloves"),
    ("transportation", ("vehicle", "truck", "forklift", "car", "collision"),
     "traffic on site", "mark separate lanes for people on foot"),
    ("fire_explosion", ("fire", "explosion", "exploded", "flame", "ignited"),
     "flammable material", "move fuel away from hot work"),
    ("violence", ("assault", "assaulted", "attacked", "bitten", "punched"),
     "hostile act", "never leave one person alone at the counter"),
)
# The words that tell a tier, gravest first; none found: minor.
SEVERITY_WORDS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("severe", ("died", "fatal", "killed", "amputated", "amputation", "unconscious")),
    ("serious", ("fracture", "fractured", "broken", "hospital", "surgery", "concussion")),
    ("moderate", ("sprain", "sprained", "stitches", "bruised", "swelling", "burned")),
)
SEVERITY_DEFAULT = "minor"


def keyword_pattern(words) -> str:
    """Whole-word alternation.  Boundaries are spelled out as [^a-z] (not
    \\b, whose notion of a word character differs between regex engines)."""
    return "(^|[^a-z])(" + "|".join(words) + ")([^a-z]|$)"


OTHER_FACTOR = "not stated"
OTHER_ACTION = "ask the crew what happened and complete the record"
MATCH_CONFIDENCE = 0.9
ABSTAIN_CONFIDENCE = 0.2

_KEYWORD_RANK = {w: i for i, (_, words, _, _) in enumerate(RULES) for w in words}
_SEVERITY_RANK = {w: i for i, (_, words) in enumerate(SEVERITY_WORDS) for w in words}
# Single-pass matching reports one word per position; that equals the test of
# every word as long as no word is a part of a longer phrase or in both lists.
assert not any(" " in w for w in (*_KEYWORD_RANK, *_SEVERITY_RANK))
assert not _KEYWORD_RANK.keys() & _SEVERITY_RANK.keys()
_ONE_PASS = "(?<![a-z])(" + "|".join(
    sorted((*_KEYWORD_RANK, *_SEVERITY_RANK), key=lambda w: (-len(w), w))) + ")(?![a-z])"


def rule_words(text: Column) -> Column:
    """All rule words in the whole text: one regex pass, however long it is."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_ONE_PASS), 1))


def _first_of(words: Column, rank: dict[str, int], names: Sequence[str], default: str) -> Column:
    ranks = F.create_map(*[F.lit(x) for w, r in rank.items() for x in (w, r)])
    best = F.array_min(F.transform(words, lambda w: F.try_element_at(ranks, w)))
    return F.coalesce(F.try_element_at(F.array(*[F.lit(n) for n in names]), best + 1), F.lit(default))


def category_of(words: Column) -> Column:
    """First category (in rule order) with a keyword among ``rule_words``, else 'other'."""
    return _first_of(words, _KEYWORD_RANK, [r[0] for r in RULES], "other")


def severity_of(words: Column) -> Column:
    """Gravest tier with a word among ``rule_words``, else 'minor'."""
    return _first_of(words, _SEVERITY_RANK, [t for t, _ in SEVERITY_WORDS], SEVERITY_DEFAULT)


def rule_category(text: Column) -> Column:
    return category_of(rule_words(text))


def rule_severity(text: Column) -> Column:
    return severity_of(rule_words(text))


def _by_category(cat: Column, idx: int, default: str) -> Column:
    m = F.create_map(*[F.lit(x) for r in RULES for x in (r[0], r[idx])])
    return F.coalesce(F.try_element_at(m, cat), F.lit(default))


def with_rule_reply(df: DataFrame, text: str, out: str = "reply") -> DataFrame:
    """Add the keyword rules' JSON reply for ``text``.  Every text is answered;
    one without a keyword is 'other' with low confidence.  The words are found
    once, in a projection of their own."""
    staged = df.withColumn("_rule_words", rule_words(F.col(text)))
    staged = staged.withColumn("_rule_cat", _first_of(
        F.col("_rule_words"), _KEYWORD_RANK, [r[0] for r in RULES], "other"))
    cat = F.col("_rule_cat")
    reply = reply_json(
        _by_category(cat, 2, OTHER_FACTOR),
        _first_of(F.col("_rule_words"), _SEVERITY_RANK, [t for t, _ in SEVERITY_WORDS], SEVERITY_DEFAULT),
        cat,
        _by_category(cat, 3, OTHER_ACTION),
        F.when(cat == "other", F.lit(ABSTAIN_CONFIDENCE)).otherwise(F.lit(MATCH_CONFIDENCE)),
    )
    return staged.withColumn(out, reply).drop("_rule_words", "_rule_cat")


def rule_classifier(text_col: str = "narrative_text") -> Classifier:
    def classify(requests: DataFrame) -> DataFrame:
        return with_rule_reply(requests, text_col)
    return classify


# ---------------------------------------------------------------------------
# External model hook: Arrow batches, client built once per partition, a bad
# row never fails its task.
# ---------------------------------------------------------------------------

def waits(retries: int, base: float, cap: float) -> Iterator[float]:
    """Seconds to wait before each retry: random, up to a bound that doubles
    from ``base`` and stops at ``cap``."""
    bound = base
    for _ in range(retries):
        yield random.random() * min(bound, cap)
        bound *= 2


def ask(call: Callable[[object, str], str | None], client: object, prompt: str,
        pauses: Iterator[float], transient: tuple[type[BaseException], ...]) -> tuple[str | None, str | None]:
    """The reply and, where there is none, the cause.  Transient errors are
    tried again while ``pauses`` lasts."""
    for pause in chain(pauses, (None,)):
        try:
            reply = call(client, prompt)
            return reply, None if reply is not None else "the model gave no reply"
        except Exception as error:  # noqa: BLE001 - the row fails, not the task
            cause = f"{type(error).__name__}: {error}"
            if pause is None or not isinstance(error, transient):
                break
        time.sleep(pause)
    return None, cause


class Deadline(TimeoutError):
    """A call took longer than it may."""


def within(seconds: float | None, call: Callable[[object, str], str | None]) -> Callable[[object, str], str | None]:
    """``call`` with a deadline.  It runs in a thread of its own, which is left
    behind when the time is over: a thread cannot be stopped, but it holds up
    neither its task nor the end of its process."""
    if seconds is None:
        return call

    def timed(client: object, prompt: str) -> str | None:
        got: list = []

        def run() -> None:
            try:
                got.append((call(client, prompt), None))
            except BaseException as error:  # noqa: BLE001 - raised again by the caller
                got.append((None, error))

        thread = threading.Thread(target=run, daemon=True)
        thread.start()
        thread.join(seconds)
        if not got:
            raise Deadline(f"no reply within {seconds} s")
        reply, error = got[0]
        if error is not None:
            raise error
        return reply

    return timed


def pandas_classifier(make_client: Callable[[], object],
                      call: Callable[[object, str], str | None],
                      retryable: tuple[type[BaseException], ...] = (ConnectionError, TimeoutError),
                      max_retries: int = 3, base_seconds: float = 1.0,
                      cap_seconds: float = 30.0, prompt_col: str = "prompt",
                      concurrency: int = 1, deadline_seconds: float | None = 120.0) -> Classifier:
    """Wrap ``call(client, prompt) -> reply`` as a ``mapInPandas`` classifier
    that adds ``reply`` and ``cause`` (null unless the call failed).  The
    reply is validated downstream with native expressions.

    A partition has up to ``concurrency`` calls under way, each with a client of
    its own that is used again.  A call that takes longer than
    ``deadline_seconds`` counts as a ``Deadline`` error, which is transient: it
    is tried again with a new client, since the old one may still be in use.
    At most ``concurrency * (max_retries + 1)`` threads per row of hanging calls
    are left behind; the row's cause then names the deadline.
    """
    timed = within(deadline_seconds, call)

    def run(batches):
        idle: queue.SimpleQueue = queue.SimpleQueue()  # clients that no call is using

        def fresh(prompt: str) -> tuple[str | None, str | None]:
            def use(_, text):
                try:
                    client = idle.get_nowait()
                except queue.Empty:
                    client = make_client()
                try:
                    reply = timed(client, text)
                except Deadline:
                    raise
                except BaseException:
                    idle.put(client)
                    raise
                idle.put(client)
                return reply

            return ask(use, None, prompt, waits(max_retries, base_seconds, cap_seconds), retryable)

        with ThreadPoolExecutor(concurrency) as pool:
            for pdf in batches:
                got = list(pool.map(fresh, pdf[prompt_col]))
                yield pdf.assign(reply=[r for r, _ in got], cause=[c for _, c in got])

    def classify(requests: DataFrame) -> DataFrame:
        schema = T.StructType(requests.schema.fields + [
            T.StructField("reply", T.StringType()), T.StructField("cause", T.StringType())])
        return requests.mapInPandas(run, schema=schema)
    return classify


# ---------------------------------------------------------------------------
@dataclass
class EnrichResult:
    rows: DataFrame        # one row per input row with status and answer
    target: DataFrame      # enrichment table after the upsert
    cache: DataFrame       # cache after insert-if-absent
    counters: DataFrame    # one row of run counters
    updates: DataFrame     # this run's rows of the enrichment table
    new_answers: DataFrame  # this run's rows of the cache


def empty_cache(spark) -> DataFrame:
    # the filter tells the optimizer that there are no rows to join
    return spark.createDataFrame([], CACHE_SCHEMA).where(F.lit(False))


def empty_enrichment(spark) -> DataFrame:
    return spark.createDataFrame([], ENRICHMENT_SCHEMA).where(F.lit(False))


def prepare_rows(staged: DataFrame, id_col: str = "incident_id",
                 fields: Sequence[str] = NARRATIVE_FIELDS,
                 sector_col: str | None = "industry_description",
                 key_includes_sector: bool = False) -> DataFrame:
    """Cleaned fields plus the content key.  By default the key covers the
    narrative fields only (so one answer serves every row with the same
    text); ``key_includes_sector`` adds the sector, which the prompt also
    carries, so texts from different industries are classified separately."""
    sector = clean_text(F.col(sector_col)) if sector_col else F.lit(None).cast("string")
    rows = staged.select(
        F.col(id_col).cast("string").alias("incident_id"),
        *[clean_text(F.col(f)).alias(f) for f in fields],
        sector.alias("sector"),
    )
    key_cols = [*fields, "sector"] if key_includes_sector else list(fields)
    return rows.withColumn("content_hash", content_hash(*key_cols))


def counters(rows: DataFrame) -> DataFrame:
    s = F.col("status")
    return rows.agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(s != STATUS_FAILED).alias("rows_succeeded"),
        F.count_if(s == STATUS_FAILED).alias("rows_failed"),
        F.count_if(s == STATUS_CACHED).alias("rows_from_cache"),
        F.count_if(s == STATUS_CLASSIFIED).alias("texts_classified"),
    )


ANSWER_SCHEMA = T.StructType([
    T.StructField("content_hash", T.StringType(), False),
    T.StructField("rep_id", T.StringType()),
    *[f for f in CACHE_SCHEMA.fields if f.name in CLASSIFICATION_FIELDS],
    T.StructField("is_valid", T.BooleanType()),
    T.StructField("reject_reason", T.StringType()),
    T.StructField("cause", T.StringType()),
])


def lookup_cached(keys: DataFrame, cache: DataFrame, prompt_version: str, columns: Sequence[str]) -> DataFrame:
    """``keys(incident_id, content_hash)`` left joined to the cached answers
    of a prompt version."""
    cached = cache.where(F.col("prompt_version") == prompt_version).select("content_hash", *columns)
    return balanced_join(keys, cached, "content_hash", F.col("incident_id"), "left")


def uncached(keys: DataFrame, cache: DataFrame, prompt_version: str) -> DataFrame:
    """The ``keys`` whose text has no cached answer of a prompt version."""
    cached = cache.where(F.col("prompt_version") == prompt_version).select("content_hash")
    return balanced_join(keys, cached, "content_hash", F.col("incident_id"), "left_anti")


def answer(requests: DataFrame, classify: Classifier) -> DataFrame:
    """Classified and validated answers, one per request (``ANSWER_SCHEMA``)."""
    replied = classify(requests)
    if "cause" not in replied.columns:
        replied = replied.withColumn("cause", F.lit(None).cast("string"))
    checked = with_validated(replied.select("content_hash", "rep_id", "reply", "cause"), "reply", "v")
    return checked.select(
        "content_hash", "rep_id", *[F.col(f"v.{c}").alias(c) for c in CLASSIFICATION_FIELDS],
        F.col("v.is_valid").alias("is_valid"), F.col("v.reject_reason").alias("reject_reason"), "cause")


def miss_texts(rows: DataFrame, misses: DataFrame, fields: Sequence[str], most: bool) -> DataFrame:
    """``content_hash, incident_id``, the ``fields`` and ``sector`` of the
    representative row of every miss, one row each.  ``most``: most texts of
    ``rows`` are misses."""
    if not most:
        return rows.join(misses.withColumnRenamed("rep_id", "incident_id"), ["content_hash", "incident_id"]
                         ).dropDuplicates(["content_hash"])  # rows may repeat
    first = (rows.where(F.col("incident_id").isNotNull()).groupBy("content_hash")
             .agg(F.min(F.struct("incident_id", *fields, "sector")).alias("first")))
    # joined on the hash alone, by which the rows are dealt out already
    return first.join(misses.select("content_hash"), "content_hash", "left_semi").select("content_hash", "first.*")


def enrich(staged: DataFrame, cache: DataFrame, target: DataFrame, classify: Classifier,
           run_ts: datetime, model_name: str, prompt_version: str = PROMPT_VERSION,
           id_col: str = "incident_id", fields: Sequence[str] = NARRATIVE_FIELDS,
           sector_col: str | None = "industry_description", key_includes_sector: bool = False,
           limit: int | None = None, calls: int | None = None, batches: int = 1,
           answers_path: str | None = None) -> EnrichResult:
    """Enrich ``staged`` rows; see the module docstring for the steps.

    ``limit``: at most so many rows, by id.  ``calls``: partitions that call
    the model at a time (a call takes seconds, so bytes say nothing about the
    right number).  ``batches``: the misses are classified and stored in so
    many parts.  ``answers_path``: where answers are stored, a folder that all
    executors share; valid answers that a broken-off run left there are not
    asked for again.  Without it a fresh one below the checkpoint folder.
    """
    spark, fields = staged.sparkSession, list(fields)
    rows = prepare_rows(staged, id_col, fields, sector_col, key_includes_sector)
    keys = rows.select("incident_id", "content_hash")
    if limit is not None:
        keys = keys.orderBy("incident_id", "content_hash").limit(limit)
    keys = materialise(keys, "content-keys", "zstd")
    cached = (cache.where(F.col("prompt_version") == prompt_version)
              .select("content_hash", *CLASSIFICATION_FIELDS))

    # narrow: one id per distinct text without a cached answer
    groups = materialise(keys.groupBy("content_hash").agg(
        F.min("incident_id").alias("rep_id"), F.count(F.lit(1)).alias("n")), "content-groups", "zstd")
    misses = groups.drop("n").join(cached.select("content_hash"), "content_hash", "left_anti")
    path = answers_path or scratch_path(spark, "answers")
    if answers_path:
        stored = read_or_empty(spark, path, ANSWER_SCHEMA).where("is_valid").select("content_hash").distinct()
        misses = misses.join(stored, "content_hash", "left_anti")
    misses = materialise(misses, "content-misses", "zstd")
    texts = miss_texts(rows, misses, fields, 2 * misses.count() > groups.count())
    if batches > 1:  # the staged texts are read once, and each batch reads its own part
        texts_path = scratch_path(spark, "content-texts")
        (texts.withColumn("batch", F.pmod(F.xxhash64("content_hash"), F.lit(batches)))
         .write.partitionBy("batch").parquet(texts_path))
        texts = spark.read.schema(T.StructType(
            [*texts.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(texts_path)
    for part in range(batches):
        found = texts if batches == 1 else texts.where(F.col("batch") == part)
        found = found.repartition(calls, "content_hash") if calls else found
        requests = found.select(
            "content_hash", F.col("incident_id").alias("rep_id"), F.lit(INSTRUCTIONS).alias("instructions"),
            render_prompt({f: f for f in fields}, F.col("sector")).alias("prompt"),
            F.concat_ws("\n", *fields).alias("narrative_text"))
        with shuffles_freed(spark):
            answer(requests, classify).write.mode("append").parquet(path)
    fresh = read_or_empty(spark, path, ANSWER_SCHEMA)
    if answers_path:  # a text that failed before and was asked again: the valid answer counts
        fresh = fresh.groupBy("content_hash").agg(F.max_by(F.struct(*fresh.columns), "is_valid").alias("a")).select("a.*")
        fresh = fresh.join(cached.select("content_hash"), "content_hash", "left_anti")
    fresh = fresh.withColumn("from_cache", F.lit(False))
    answers = cached.select(
        "content_hash", F.lit(None).cast("string").alias("rep_id"), *CLASSIFICATION_FIELDS,
        F.lit(True).alias("is_valid"), F.lit(None).cast("string").alias("reject_reason"),
        F.lit(None).cast("string").alias("cause"), F.lit(True).alias("from_cache"),
    ).unionByName(fresh)

    hot = hot_keys(groups, "content_hash")
    joined = salted_join(keys, answers, "content_hash", hot, F.col("incident_id"), "left")
    status = (F.when(F.col("is_valid").isNull() | ~F.col("is_valid"), F.lit(STATUS_FAILED))
              .when(F.col("from_cache"), F.lit(STATUS_CACHED))
              .when(F.col("incident_id") == F.col("rep_id"), F.lit(STATUS_CLASSIFIED))
              .otherwise(F.lit(STATUS_CACHED)))
    per_row = joined.select(
        "incident_id", "content_hash", *CLASSIFICATION_FIELDS,
        status.alias("status"),
        F.when(F.col("is_valid").isNull(), F.lit("no_reply"))
        .when(~F.col("is_valid"), F.coalesce(F.col("reject_reason"), F.lit("no_reply")))
        .alias("reject_reason"),
        "cause",
    )
    per_row = materialise(per_row, "content-status", "zstd")  # counters, updates and rows read it

    ts = F.lit(run_ts).cast("timestamp_ntz")
    updates = per_row.where(F.col("status") != STATUS_FAILED).select(
        "incident_id", *CLASSIFICATION_FIELDS, F.lit(prompt_version).alias("prompt_version"),
        F.lit(model_name).alias("model_name"), ts.alias("enriched_at"))
    new_cache_rows = fresh.where("is_valid").select(
        "content_hash", F.lit(prompt_version).alias("prompt_version"), *CLASSIFICATION_FIELDS,
        F.lit(model_name).alias("model_name"), ts.alias("cached_at"))
    return EnrichResult(
        rows=per_row,
        target=upsert_by_key(target, updates, ["incident_id"]),
        cache=insert_if_absent(cache, new_cache_rows, ["content_hash", "prompt_version"]),
        counters=counters(per_row),
        updates=updates,
        new_answers=new_cache_rows.join(
            cache.select("content_hash", "prompt_version"), ["content_hash", "prompt_version"], "left_anti"
        ).select(*cache.columns),
    )
