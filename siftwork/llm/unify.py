"""Problem 7: visually identical text written with other characters.

``unify_text`` repairs every text: full-width forms, ligatures, combining marks, invisible
characters and odd blanks by fixed rules; look-alike letters by script: in each word that
mixes scripts the dominant script is found, the look-alikes are replaced by its letters, and
the result stays only when the word exists, written in one script, somewhere in the corpus.

Plan: two scans.  The first (Arrow batches; texts without a suspect character leave the inspection
after a single regex search) sends what is narrow: the corpus' words, each task every word once, and the few rows
that have a mixed-script word, inspected.  Both are kept in the shared folder; the mixed words' repaired forms are semi-joined with
the distinct words, and what is accepted goes back to its rows.  The second scan repairs all other rows by
the fixed rules and is a map.  Texts without a mixed word are never shuffled, kept or broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.llm import cleanup
from siftwork.operators.checkpoints import cut

#: Words a task remembers to send each once; when full, it starts anew and repeats some.
SEEN_WORDS = 500_000


def _inspect(text: str | None) -> tuple[str | None, list[str], list[dict]]:
    if text is None:
        return None, [], []
    if not cleanup.SUSPECT.search(text):
        return text, [], []
    clean = cleanup.simple_fold(text)
    mixed = {w: cleanup.repaired(w) for w in cleanup.mixed_words(clean)}
    return clean, cleanup.kinds_of(text), [{"word": w, "fixed": f} for w, f in mixed.items() if f]


_MIXED = pa.list_(pa.struct([("word", pa.string()), ("fixed", pa.string())]))


def _scanned(df: DataFrame, text_col: str) -> DataFrame:
    """The rows with a mixed-script word, inspected (unify_clean, unify_kinds, unify_mixed), and, in rows of nothing else, the words of all texts that are written in one script (unify_word: lower case, letters only)."""
    names = df.columns
    schema = T.StructType(
        [
            *[T.StructField(f.name, f.dataType) for f in df.schema.fields],
            T.StructField("unify_clean", T.StringType()),
            T.StructField("unify_kinds", T.ArrayType(T.StringType())),
            T.StructField("unify_mixed", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("fixed", T.StringType())]))),
            T.StructField("unify_word", T.StringType()),
        ]
    )
    at = names.index(text_col)
    added = ["unify_clean", "unify_kinds", "unify_mixed", "unify_word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for b in batches:
            new: set[str] = set()
            rows, found = [], []
            for i, t in enumerate(b.column(at).to_pylist()):
                if t is None:
                    continue
                clean, kinds, mixed = _inspect(t)
                if mixed:
                    rows.append(i)
                    found.append((clean, kinds, mixed))
                new.update(cleanup.LETTERS.findall(clean.lower()))
            new -= seen
            if len(seen) > SEEN_WORDS:
                seen.clear()
            seen |= new
            keep = [w for w in new if not cleanup.SUSPECT.search(w) or sum(n > 0 for n in cleanup.scripts(w)) == 1]
            n = len(keep)
            yield pa.RecordBatch.from_arrays([*[pa.nulls(n, c.type) for c in b.columns], pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, _MIXED), pa.array(keep, pa.string())], names=[*names, *added])
            if rows:
                taken = b.take(pa.array(rows, pa.int64())).columns
                arrays = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.string(), pa.list_(pa.string()), _MIXED), strict=True)]
                yield pa.RecordBatch.from_arrays([*taken, *arrays, pa.nulls(len(rows), pa.string())], names=[*names, *added])

    return df.mapInArrow(run, schema)


def _plain(df: DataFrame, text_col: str) -> DataFrame:
    """The rows without a mixed-script word to repair, with ``unified`` and ``kinds``."""
    names = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField("unified", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType()))])
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_inspect(t) for t in b.column(at).to_pylist()]
            rows = [i for i, f in enumerate(found) if not f[2]]
            taken = b.take(pa.array(rows, pa.int64())).columns
            yield pa.RecordBatch.from_arrays([*taken, pa.array([found[i][0] for i in rows], pa.string()), pa.array([found[i][1] for i in rows], pa.list_(pa.string()))], names=[*names, "unified", "kinds"])

    return df.mapInArrow(run, schema)


def unify_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with two columns more: ``unified`` (the text in its one form) and ``kinds`` (what was found, of cleanup.KINDS).

    Null texts stay null with no kinds; empty texts stay empty.  Extra columns pass through
    (names beginning with ``unify_`` are taken); equal rows stay as many as they were.  A mixed-script word whose
    repaired form the corpus doesn't know keeps its letters, and its kind is still told.
    """
    # numbers of rows are stable, as they are given to what is kept
    scanned = cut(_scanned(df, text_col)).withColumn("unify_row", F.monotonically_increasing_id())
    rows = scanned.where("unify_word is null")
    known = scanned.where("unify_word is not null").select(F.col("unify_word").alias("lower")).distinct()
    asked = rows.select("unify_row", F.explode("unify_mixed").alias("m")).select("unify_row", "m.word", "m.fixed")
    accepted = asked.select("word", "fixed").distinct().withColumn("lower", F.lower("fixed")).join(known, "lower", "left_semi").select("word")
    fixes = asked.join(accepted, "word").groupBy("unify_row").agg(F.map_from_entries(F.collect_set(F.struct("word", "fixed"))).alias("unify_fix"))

    @F.pandas_udf("string")
    def apply_fix(text, fix):
        import pandas as pd

        def one(t, f):
            f = dict(f) if f is not None else {}
            return cleanup.LETTERS.sub(lambda m: f.get(m[0], m[0]), t) if f else t

        return pd.Series([one(t, f) for t, f in zip(text, fix, strict=True)], dtype=object)

    fixed = rows.join(fixes, "unify_row", "left").select(*df.columns, apply_fix("unify_clean", "unify_fix").alias("unified"), F.col("unify_kinds").alias("kinds"))
    return _plain(df, text_col).unionByName(fixed)
