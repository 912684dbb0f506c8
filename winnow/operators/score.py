"""Label scoring (SCO-1..4, TXT-10..12, SRT-4, JON-1).

A scorer turns one text (or vector) into a ``map<label, score>`` column.
Two scorers are plain Column expressions and stay inside whole-stage codegen:

* ``lexical_scores`` - share of a label's distinct words found in the text;
* ``cosine_scores``  - cosine between a vector column and one reference
  vector per label (a small table).

A user model (for example a zero-shot classifier) goes through
``model_scores``: ``mapInArrow``, the model built once per Python worker, called
on ``batch_size`` texts at a time. Every label gets an
independent score per text, so methods and applications can be scored in one
pass; ``merge_dimensions`` still joins separately scored sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import hashlib

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import DEFAULT_BATCH_SIZE, SCORE_DECIMALS, TAG_THRESHOLD
from ..functions.text import norm_title
from ..session import ship_package
from .report import lc


def _col(c: Column | str) -> Column:
    return lc(c) if isinstance(c, str) else c


def title_words(text: Column | str, normalised: bool = False) -> Column:
    """Distinct words of a text after the title rules (TXT-3)."""
    t = _col(text) if normalised else norm_title(_col(text))
    return F.array_distinct(F.array_remove(F.split(t, " "), ""))


def lexical_scores(words: Column | str, labels: Sequence[str]) -> Column:
    """Per label: distinct label words present in ``words`` (an array from
    ``title_words``) divided by the number of distinct label words (0.0 for a
    label without words)."""
    t = _col(words)
    scores = []
    for label in labels:
        lw = title_words(F.lit(label))
        hit = F.size(F.array_intersect(lw, t)).cast("double")
        scores.append(F.when(F.size(lw) > 0, hit / F.size(lw)).otherwise(F.lit(0.0)))
    return F.map_from_arrays(F.array(*[F.lit(l) for l in labels]), F.array(*scores))


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns`` as generated ones: made by ``inline`` of one struct.
    The optimiser copies the expression of a plain column into every filter and
    projection above it; it moves nothing through a generator, so costly columns
    (scores) are evaluated once a row, however often they are named later."""
    kept = [lc(c) for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_lexical_scores(df: DataFrame, text_col: str, labels: Sequence[str], out: str = "scores",
                        normalised: bool = False) -> DataFrame:
    """Adds ``out``; the text is split once into a word array that every
    label reuses, and the scores are generated once (``computed_once``)."""
    words = df.withColumn("_words", title_words(text_col, normalised))
    return computed_once(words, {out: lexical_scores("_words", labels)}).drop("_words")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def label_vectors(df: DataFrame, label_col: str, vec_col: str, order_col: str,
                  labels: Sequence | None = None) -> DataFrame:
    """``(label, vec, norm)``: the reference vector of each label, that of the
    smallest ``order_col``, as doubles, with its length."""
    src = df if labels is None else df.filter(lc(label_col).isin(list(labels)))
    vec = F.min_by(lc(vec_col), lc(order_col)).cast("array<double>")
    return (src.groupBy(lc(label_col).cast("string").alias("label")).agg(vec.alias("vec"))
            .withColumn("norm", F.sqrt(_dot(F.col("vec"), F.col("vec")))))


def cosine_scores(df: DataFrame, vec_col: str, vectors: DataFrame, out: str = "scores") -> DataFrame:
    """Adds ``out``, a map from every label of ``vectors`` (see
    ``label_vectors``) to its cosine with the row's vector; null for a zero
    vector. The label table enters as a scalar subquery, so its vectors are
    not part of the plan's text; a row's length is computed once."""
    table = vectors.agg(F.array_sort(F.collect_list(F.struct("label", "vec", "norm")))).scalar()
    rows = df.withColumns({"_v": lc(vec_col).cast("array<double>"), "_refs": table})
    rows = rows.withColumn("_norm", F.sqrt(_dot(F.col("_v"), F.col("_v"))))
    scored = F.transform("_refs", lambda r: F.struct(
        r["label"], F.try_divide(_dot(F.col("_v"), r["vec"]), F.col("_norm") * r["norm"])))
    return computed_once(rows, {out: F.map_from_entries(scored)}).drop("_v", "_refs", "_norm")


def map_scores_long(scored: DataFrame, id_cols: Sequence[str], scores: str = "scores",
                    decimals: int | None = SCORE_DECIMALS) -> DataFrame:
    """``(id..., label, score)`` of every entry of the score map."""
    out = scored.select(*[lc(c) for c in id_cols], F.explode(scores).alias("label", "score"))
    return out.withColumn("score", round_score("score", decimals)) if decimals is not None else out


_MODELS: dict[str, object] = {}  # of this Python worker
OUT_ROWS = 4096  # scored rows handed back at a time


def model_scores(df: DataFrame, text_col: str, labels: Sequence[str], factory: Callable[[], Callable],
                 batch_size: int = DEFAULT_BATCH_SIZE, cache_key: str | None = None,
                 id_cols: Sequence[str] = ("row_id",)) -> DataFrame:
    """SCO-2 with a user model: ``model(texts, labels)`` returns one
    ``{'labels': [...], 'scores': [...]}`` per text. Gives ``id_cols`` and a
    ``scores`` map; only these columns and the text go through Arrow.

    Runs in ``mapInArrow``: the rows of a partition are batched anew across
    Arrow's batches, so every call but a partition's last gets ``batch_size`` texts
    and a partition of n rows makes ``ceil(n / batch_size)`` calls (``model_calls``).
    The model is built once per Python worker. The cache lives in this module as the
    worker imports it (a closure's own dictionary would be new in every task), so the
    package must be importable there. Empty partitions yield nothing."""
    labels = list(labels)
    # the factory's pickled bytes identify it: two closures with the same
    # name but different captured settings (model name, device) get two models
    key = cache_key or hashlib.sha1(cloudpickle.dumps(factory)).hexdigest()
    ship_package(df.sparkSession)
    rows = df.select(*[lc(c) for c in id_cols], lc(text_col).cast("string").alias("_text"))
    schema = T.StructType([*rows.drop("_text").schema.fields, T.StructField("_labels", T.ArrayType(T.StringType())),
                           T.StructField("_scores", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from winnow.operators import score as own

        model = own._MODELS.get(key)
        if model is None:
            model = own._MODELS[key] = factory()
        held: list[pa.RecordBatch] = []  # rows that are read and not handed back yet
        texts: list[str] = []  # of the held rows that are not scored yet
        out_l: list[list[str]] = []
        out_s: list[list[float]] = []

        def call() -> None:
            for r in model(texts[:batch_size], labels):
                out_l.append([str(x) for x in r["labels"]])
                out_s.append([float(x) for x in r["scores"]])
            del texts[:batch_size]

        def scored() -> Iterator[pa.RecordBatch]:
            """The held rows that have scores."""
            n = len(out_l)
            table = pa.Table.from_batches(held)
            done = table.slice(0, n).combine_chunks()
            held[:] = table.slice(n).to_batches()
            columns = [*done.columns, pa.array(out_l, pa.list_(pa.string())), pa.array(out_s, pa.list_(pa.float64()))]
            yield from pa.table(columns, names=[*done.column_names, "_labels", "_scores"]).to_batches()
            out_l.clear()
            out_s.clear()

        for batch in batches:
            if batch.num_rows:
                held.append(batch.drop_columns(["_text"]))
                texts += [t or "" for t in batch.column("_text").to_pylist()]
                while len(texts) >= batch_size:
                    call()
                if len(out_l) >= OUT_ROWS:
                    yield from scored()
        if texts:
            call()
        if out_l:
            yield from scored()

    out = rows.mapInArrow(run, schema)
    return out.withColumn("scores", F.map_from_arrays("_labels", "_scores")).drop("_labels", "_scores")


def model_calls(df: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """AGG-20 as ``model_scores`` runs: calls by partition, added up, ``(batches)``."""
    parts = df.groupBy(F.spark_partition_id().alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    return parts.agg(F.coalesce(F.sum(F.ceil(F.col("_n") / F.lit(batch_size))), F.lit(0)).cast("long").alias("batches"))


def round_score(c: Column | str, decimals: int = SCORE_DECIMALS) -> Column:
    """TXT-10: round half up to ``decimals`` places; ``+ 0.0`` turns a
    rounded -0.0 into 0.0 so equal scores hash equally."""
    return F.round(_col(c), decimals) + F.lit(0.0)


def score_of(scores: Column | str, label: str) -> Column:
    """TXT-12: the label's score, 0.0 when the model gave none."""
    return F.coalesce(F.try_element_at(_col(scores), F.lit(label)), F.lit(0.0))


def scores_long(scored: DataFrame, id_cols: Sequence[str], labels: Sequence[str], scores: str = "scores",
                decimals: int | None = SCORE_DECIMALS) -> DataFrame:
    """``(id..., label, score)``, one row per text and requested label."""
    entries = [F.struct(F.lit(l).alias("label"), score_of(scores, l).alias("score")) for l in labels]
    out = scored.select(*[lc(c) for c in id_cols], F.inline(F.array(*entries)))
    return out.withColumn("score", round_score("score", decimals)) if decimals is not None else out


def threshold_tags(scored: DataFrame, labels: Sequence[str], threshold: float = TAG_THRESHOLD,
                   scores: str = "scores", decimals: int = SCORE_DECIMALS, keep_scores: bool = False) -> DataFrame:
    """SCO-3 / TXT-10 / TXT-11: per label a 0/1 tag (strict ``>`` on the
    unrounded score) and ``<label>_score`` rounded to ``decimals`` places."""
    cols = {}
    for l in labels:
        s = score_of(scores, l)
        cols[l] = (s > F.lit(threshold)).cast("int")
        cols[f"{l}_score"] = round_score(s, decimals)
    out = scored.withColumns(cols)
    return out if keep_scores else out.drop(scores)


def tag_dimensions(scored: DataFrame, dimensions: Sequence[tuple[float, Sequence[str]]], scores: str = "scores",
                   decimals: int = SCORE_DECIMALS) -> DataFrame:
    """SCO-4 in one pass: texts scored once against every label (scores are
    independent per label), then each dimension tagged at its own threshold
    - the same columns as scoring each dimension separately and joining them
    on the key, without the second scoring pass and the join."""
    out = scored
    for threshold, labels in dimensions:
        out = threshold_tags(out, labels, threshold, scores=scores, decimals=decimals, keep_scores=True)
    return out.drop(scores)


def inference_batches(df: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """AGG-20: number of batches of all rows in one sequence, ``ceil(rows /
    batch_size)``; ``model_calls`` counts those of the partitions."""
    return df.agg(F.ceil(F.count(F.lit(1)) / F.lit(batch_size)).cast("long").alias("batches"))


def top_labels(scored: DataFrame, id_cols: Sequence[str], k: int = 3, scores: str = "scores") -> DataFrame:
    """SRT-4: the ``k`` best labels of every text, ``(id..., rank, label,
    score)``; ties broken by label."""
    entries = F.transform(F.map_entries(_col(scores)),
                          lambda e: F.struct((-e["value"]).alias("neg"), e["key"].alias("label")))
    best = F.slice(F.sort_array(entries), 1, k)
    return scored.select(*[lc(c) for c in id_cols], F.posexplode(best).alias("pos", "e")).select(
        *[lc(c) for c in id_cols], (F.col("pos") + 1).alias("rank"), F.col("e.label").alias("label"),
        (-F.col("e.neg")).alias("score"))


def label_index(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """``(word, label, size)``: every word of every label with the label's number
    of words; a label without words has one row with a null word."""
    words = labels.select(lc(label_col).alias("label")).distinct().withColumn("_w", title_words("label"))
    return words.select("label", F.size("_w").alias("size"), F.explode_outer("_w").alias("word"))


def indexed_scores(df: DataFrame, id_cols: Sequence[str], text_col: str, index: DataFrame, normalised: bool = False) -> DataFrame:
    """SCO-2 for thousands of labels: the lexical scores above zero, ``(id..., label,
    score)``. The words of titles meet the words of labels in an inverted index
    (``label_index``), so a title touches only labels that it has a word of; no
    table of titles x labels is made. A title without a hit has one row with a
    null label. A word in a third of all titles is a skewed left side, which
    adaptive execution splits."""
    ids = [lc(c) for c in id_cols]
    words = df.select(*ids, F.explode_outer(title_words(text_col, normalised)).alias("word"))
    met = words.join(index.filter(F.col("word").isNotNull()), "word", "left")
    return met.groupBy(*ids, "label").agg((F.count("size") / F.max("size")).alias("score"))


def top_labels_indexed(df: DataFrame, id_cols: Sequence[str], text_col: str, labels: DataFrame, k: int = 3,
                       normalised: bool = False) -> DataFrame:
    """SRT-4 by the inverted index, the same rows as ``top_labels`` of the score
    map: ``(id..., rank, label, score)``, ties by label. ``labels`` is a table with a
    ``label`` column. A title keeps its ``k`` best hits (bounded before the shuffle);
    one with fewer is filled up with the first labels that it does not hit, which
    are among the first 2k of all."""
    index = label_index(labels)
    hits = indexed_scores(df, id_cols, text_col, index, normalised)
    place = Window.partitionBy(*[lc(c) for c in id_cols]).orderBy(F.desc_nulls_last("score"), "label")
    best = hits.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    entry = F.when(F.col("label").isNotNull(), F.struct("rank", "label", "score"))
    found = best.groupBy(*[lc(c) for c in id_cols]).agg(F.array_sort(F.collect_list(entry)).alias("_found"))
    first = (labels.select("label").distinct().orderBy("label").limit(2 * k)
             .agg(F.array_sort(F.collect_list("label")).alias("first"))).scalar()
    rows = found.withColumn("_first", first)
    known = F.transform("_found", lambda e: F.struct(e["label"].alias("label"), e["score"].alias("score")))
    rest = F.transform(F.array_except("_first", F.transform("_found", lambda e: e["label"])), lambda l: F.struct(l.alias("label"), F.lit(0.0).alias("score")))
    return rows.select(*[lc(c) for c in id_cols], F.posexplode(F.slice(F.concat(known, rest), 1, k)).alias("_p", "_e")).select(
        *[lc(c) for c in id_cols], (F.col("_p") + 1).alias("rank"), F.col("_e.label").alias("label"), F.col("_e.score").alias("score"))


def merge_dimensions(left: DataFrame, right: DataFrame, right_labels: Sequence[str], key: str = "dedup_key",
                     suffix: str = "_app") -> DataFrame:
    """JON-1: left join of two scored sets on ``key``; the right side is
    pruned to key + labels + scores and a clashing name gets ``suffix``.
    Both sides hold one row per key, so the join is 1:1 and has no hot key."""
    keep = [key, *right_labels, *[f"{l}_score" for l in right_labels]]
    r = right.select(*[lc(c).alias(c if c == key or c not in left.columns else f"{c}{suffix}") for c in keep])
    return left.join(r, key, "left")
