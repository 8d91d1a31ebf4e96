"""Threads to clean records by staged gates, with a pluggable model.

A model is any picklable callable (system, user) -> str; each stage sends its prompts through
``ask``, one iterator of batches a task with a pool of calls in flight, and reads the answers by
column expressions.  The result of every stage is cut in the shared folder, so a model is never
asked twice for a row that a later stage, a retry or the optimizer touches again, and rows
that a gate turned away never reach the next model.
"""

from __future__ import annotations

import json
import queue
import threading
import time
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.functions import protocol
from siftwork.functions.latex import normalize_latex, normalize_latex_each, strip_fences
from siftwork.functions.text import strip
from siftwork.operators import threads as th
from siftwork.operators.checkpoints import cut
from siftwork.schema import CLEAN_FIELDS

Model = Callable[[str, str], str]


@dataclass(frozen=True)
class Prompts:
    """System prompts of the stages.  What a stage knows of a row follows as one JSON object."""

    split: str = "You get a discussion as JSON. List the separate problems in it, as a JSON list of objects with question, post_indices and has_inline_solution."
    keep: str = "You get a problem as JSON. Is it complete, and can it be solved from its text alone? Two lines: DECISION: YES or NO, then REASON: and why."
    classify: str = "You get a problem as JSON. What kind of result does it ask for? Two lines: CATEGORY: EXACT_VALUE, EXPRESSION, PROOF or COMPLEX, then REASON: and why."
    answer: str = "You get a problem and posts as JSON. Which post solves it best and in full? One line: POST_INDEX: and its index, or NO_ANSWER."
    rewrite: str = "You get a problem and a draft as JSON. Turn the draft into a full solution in the problem's language, without any remark."
    latex: str = "Mend the LaTeX of the text and change nothing else."


@dataclass(frozen=True)
class Config:
    """How a model is asked: calls in flight a task, tries, seconds a call may take and seconds between tries (doubled each time)."""

    prompts: Prompts = field(default_factory=Prompts)
    in_flight: int = 8
    retries: int = 3
    timeout: float = 60.0
    pause: float = 1.0

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> Config:
        """Settings SIFTWORK_IN_FLIGHT, SIFTWORK_RETRIES, SIFTWORK_TIMEOUT, SIFTWORK_PAUSE and SIFTWORK_PROMPT_<stage>; those not given keep their defaults."""
        given = {n: kind(env[k]) for n, kind in (("in_flight", int), ("retries", int), ("timeout", float), ("pause", float)) if env.get(k := f"SIFTWORK_{n.upper()}")}
        prompts = {f.name: env[k] for f in fields(Prompts) if env.get(k := f"SIFTWORK_PROMPT_{f.name.upper()}")}
        return cls(prompts=Prompts(**prompts), **given)


def rule_model(system: str, user: str) -> str:
    """A deterministic stand-in for a model, for tests and dry runs: it goes by words and lengths."""
    if "LaTeX" in system:
        return user
    if "JSON list" in system:
        return "[]"  # one task for the thread
    given = json.loads(user)
    problem = given.get("problem", "")
    if "DECISION" in system:
        good = len(problem) > 50 and not given["figures"]
        return f"DECISION: {'YES' if good else 'NO'}\nREASON: {'enough text' if good else 'too short or needs a figure'}"
    if "CATEGORY" in system:
        low = problem.lower()
        kind = "PROOF" if any(w in low for w in ("wykaż", "udowodnij", "uzasadnij", "prove")) else "EXPRESSION" if any(w in low for w in ("wyznacz", "uprość", "zapisz", "find")) else "EXACT_VALUE"
        return f"CATEGORY: {kind}\nREASON: by its verb"
    if "POST_INDEX" in system:
        others = [p for p in given["posts"] if p["index"] != 0 and p["text"]]
        best = max(others, key=lambda p: len(p["text"]), default=None)
        return f"POST_INDEX: {best['index']}" if best else "NO_ANSWER"
    return given["draft"]


def _in_time(call: Callable[[], str], seconds: float) -> str:
    """The call's result; an error where it takes longer.  A call that hangs is left behind in a thread that ends with the worker."""
    got: queue.SimpleQueue = queue.SimpleQueue()

    def work() -> None:
        try:
            got.put((call(), None))
        except BaseException as e:  # noqa: BLE001  handed to the one who waits
            got.put((None, e))

    threading.Thread(target=work, daemon=True).start()
    try:
        value, error = got.get(timeout=seconds)
    except queue.Empty:
        raise TimeoutError(f"no answer within {seconds} s") from None
    if error is not None:
        raise error
    return value


def ask(df: DataFrame, out_col: str, system: str, user, model: Model, config: Config) -> DataFrame:
    """The rows with the model's answers; null where it failed, took too long or said nothing every time.  Cut at once, so that no row is asked again."""

    @F.pandas_udf("string")
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(prompt: str | None) -> str | None:
            if prompt is None:
                return None
            for k in range(config.retries):
                if k:
                    time.sleep(config.pause * 2 ** (k - 1))
                try:
                    if answer := (_in_time(lambda: model(system, prompt), config.timeout) or "").strip():
                        return answer
                except Exception:  # noqa: BLE001  a model may fail in any way; its row then has no answer
                    continue
            return None

        with ThreadPoolExecutor(config.in_flight) as pool:
            for b in batches:
                yield pd.Series(list(pool.map(one, b)), dtype=object)

    return cut(df.withColumn(out_col, call.asNondeterministic()(user)))


_COLUMNS = ("task_idx", "source_url", "source_title", "question", "kept", "filter_reason", "category", "category_reason", "raw_answer", "answer_post_index", "solution", "split_parsed", "status")
_LATER = {"task_idx": "int", "question": "string", "kept": "boolean", "filter_reason": "string", "category": "string", "category_reason": "string", "raw_answer": "string", "answer_post_index": "int", "solution": "string", "split_parsed": "boolean"}


def curate(threads: DataFrame, key_col: str, model: Model = rule_model, config: Config | None = None) -> DataFrame:
    """Full records (schema.FULL_FIELDS, key_col, task_idx, split_parsed, status) of threads with url, title, posts.

    status is kept, discarded (by the gate), no_category, no_answer or error.  A call that failed every time ends its
    row at that stage with error, whatever the stage: no failure passes a gate.  A thread whose split failed is one row without a question.
    split_parsed tells whether the answer to the split was a list; where not, the thread is one task.
    """
    config, p = config or Config(), (config or Config()).prompts
    done: list[DataFrame] = []

    def end(df: DataFrame, status) -> None:
        for c, t in _LATER.items():
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast(t))
        done.append(df.withColumn("status", F.lit(status) if isinstance(status, str) else status).select(key_col, *_COLUMNS))

    def stage(df: DataFrame, system: str, user) -> DataFrame:
        """The rows that were answered, as ``raw``; the others end here."""
        asked = ask(df.drop("raw"), "raw", system, user, model, config)
        end(asked.where("raw is null"), "error")
        return asked.where("raw is not null")

    def mend(df: DataFrame, column: str) -> DataFrame:
        """The rows with the column's LaTeX mended; blank texts are not sent."""
        blank = strip(F.coalesce(column, F.lit(""))) == ""
        asked = ask(df.drop("raw"), "raw", p.latex, F.when(~blank, F.col(column)), model, config).withColumn("raw", F.when(blank, "").otherwise(F.col("raw")))
        end(asked.where("raw is null"), "error")
        return asked.where("raw is not null").withColumn(column, strip_fences(F.col("raw"), "latex"))

    def payload(**parts):
        return F.to_json(F.struct(*[v.alias(k) for k, v in parts.items()]))

    base = threads.select(key_col, F.col("url").alias("source_url"), F.coalesce("title", F.lit("")).alias("source_title"), F.coalesce("posts", F.array().cast(threads.schema["posts"].dataType)).alias("posts"))
    base = base.withColumn("contents", normalize_latex_each(F.transform("posts", lambda x: F.coalesce(x["content"], F.lit("")))))
    base = base.withColumn("posts", th.with_contents(F.col("posts"), F.col("contents"))).drop("contents")
    split = stage(base, p.split, payload(title=F.col("source_title"), posts=th.brief(F.col("posts"), 500)))
    task = split.select(key_col, "source_url", "source_title", "posts", protocol.is_task_list(F.col("raw")).alias("split_parsed"), F.posexplode(protocol.tasks(F.col("raw"), F.col("posts"), F.col("source_title"))).alias("task_idx", "task"))
    task = task.where(F.col("task.question").isNotNull()).select("*", normalize_latex(F.col("task.question")).alias("question"), F.coalesce(F.col("task.post_indices"), F.array().cast("array<int>")).alias("indices"), F.coalesce("task.has_inline_solution", F.lit(False)).alias("inline")).drop("task")
    task = task.withColumn("near", th.relevant(F.col("posts"), F.col("indices")))

    head = F.substring("question", 1, 1000)
    gate = stage(task, p.keep, payload(problem=head, figures=th.any_images(F.col("near"))))
    gate = gate.withColumn("kept", protocol.decision(F.col("raw"))).withColumn("filter_reason", protocol.reason(F.col("raw")))
    # what the gate turns away has its LaTeX mended too, for the log
    fixed = mend(gate, "question")
    end(fixed.where("not kept"), "discarded")

    kind = stage(fixed.where("kept"), p.classify, payload(problem=head))
    kind = kind.withColumn("category", protocol.category(F.col("raw"))).withColumn("category_reason", protocol.reason(F.col("raw")))
    end(kind.where("category is null"), "no_category")
    found = stage(kind.where("category is not null"), p.answer, payload(problem=head, solved_in_place=F.col("inline"), posts=th.brief(F.col("near"), 800)))
    found = found.withColumn("answer_post_index", protocol.post_index(F.col("raw")))
    found = found.withColumn("raw_answer", th.post_content(F.col("posts"), F.col("answer_post_index")))
    end(found.where("raw_answer is null").drop("answer_post_index"), "no_answer")
    mended = mend(found.where("raw_answer is not null").withColumn("mended", F.col("raw_answer")), "mended")
    new = stage(mended, p.rewrite, payload(problem=head, draft=F.substring("mended", 1, 2000))).withColumn("solution", strip(F.col("raw")))
    last = mend(new, "solution")
    end(last, F.when(strip(F.col("solution")) != "", "kept").otherwise("error"))

    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def clean_records(full: DataFrame) -> DataFrame:
    return full.where("status = 'kept'").select(*CLEAN_FIELDS)


def statistics(full: DataFrame, key_col: str) -> DataFrame:
    """One row of counts; parse_errors counts threads whose split was no list."""
    return full.agg(
        F.count_distinct(key_col).alias("threads"),
        F.count("task_idx").alias("tasks"),
        F.count_if(F.col("status") == "kept").alias("kept"),
        F.count_if(F.col("status").isin("discarded", "no_category", "no_answer")).alias("filtered_out"),
        F.count_if(F.col("status") == "no_category").alias("classification_errors"),
        F.count_distinct(F.when(~F.col("split_parsed"), F.col(key_col))).alias("parse_errors"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )
