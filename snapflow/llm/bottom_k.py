"""Bottom-k sketches of word shingles: resemblance, containment and distinct counts of texts.

A sketch is the ascending array of the ``k`` smallest distinct 64-bit shingle hashes of a text.
It is built by column expressions in the scan; sketches of parts merge to the sketch of the whole,
so a corpus sketch never needs the texts again.

Defined results
    null or empty text        no shingle: the empty sketch; two empty sketches are alike (1.0), an
                              empty and a filled one are not (0.0)
    fewer words than a shingle  one shingle: the whole word sequence
    very long text            whole text; arrays of one entry per word, in the row's own task
    ties, repeated rows       equal texts have equal sketches; rows of one id follow each other by
                              text hash, a null id comes before all others
    empty table               empty result
    extra columns             only id and text are read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapflow.llm.common import DOC_ID, let, narrow, words_of

K = 128
SHINGLE = 5
_HALF = float(2 ** 63)


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """Hash of every ``size``-word shingle, repeats included; short texts give one, empty ones none."""
    def rolled(h: Column) -> Column:
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                .when(F.size(h) < size, F.array(F.xxhash64(h)))
                .otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - size, F.lit(0))),
                                       lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(size)]))))
    return let(F.transform(words, lambda w: F.xxhash64(w)), rolled)


def smallest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    return let(words_of(F.coalesce(text, F.lit(""))), lambda w: smallest(shingle_hashes(w, size), k))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles: of the k smallest of the union, those in both."""
    def share(union: Column) -> Column:
        both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))
    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, k), share).cast("double")


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact while the sketch is not full."""
    place = (F.element_at(s, -1).cast("double") + _HALF) / (2 * _HALF)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that are in b."""
    def share(j: Column) -> Column:
        na, nb = distinct_shingles(a, k), distinct_shingles(b, k)
        return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (na + nb) / (1 + j) / na))
    return let(resemblance(a, b, k), share)


def merged(parts: DataFrame, group: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """Sketch of each group from the sketches of its parts.  Hashes are made distinct and cut to k
    before and after the shuffle (window group limit), so a hot group sends k rows a task."""
    rows = parts.select(*group, F.explode(sketch_col).alias("h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("h"))
    return (rows.withColumn("r", rank).filter(F.col("r") <= k)
            .groupBy(*group).agg(F.sort_array(F.collect_list("h")).alias(sketch_col)))


def fingerprint(s: Column) -> Column:
    """The sketch as text: 16 hexadecimal digits a hash."""
    return F.lower(F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _range_of(key: Column, cuts: list[int]) -> Column:
    """Number of ``cuts`` (ascending) that are at most ``key``, by binary search."""
    if not cuts:
        return F.lit(0)
    steps = len(cuts).bit_length()

    def narrowed(a: Column, _: Column) -> Column:
        mid = F.shiftright(a["lo"] + a["hi"], 1)
        up = (a["lo"] < a["hi"]) & (F.get(F.lit(cuts), mid) <= key)
        return F.struct(F.when(up, mid + 1).otherwise(a["lo"]).alias("lo"),
                        F.when(up, a["hi"]).otherwise(F.least(mid, a["hi"])).alias("hi"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(steps)),
                       F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")),
                       narrowed, lambda a: a["lo"])


def _place(key: Column, ties: Column, cuts: list[int]) -> Column:
    """Range of a row: by key, and for a key that several cuts fall on (a hot one) by ``ties`` too."""
    upto = _range_of(key, cuts)
    hot = sorted({c for c in cuts if cuts.count(c) > 1})
    if not hot:
        return upto
    before = F.when(key == F.lit(-2 ** 63), F.lit(0)).otherwise(_range_of(key - 1, cuts))
    share = ties.cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)
    return F.when(key.isin(hot), before + F.least(F.floor(share * (upto - before + 1)).cast("int"), upto - before)).otherwise(upto)


def with_next(d: DataFrame, order: str, columns: list[str], ties: str,
              derived: dict[str, Column] | None = None) -> DataFrame:
    """Each row with ``next_<column>`` of the row that follows by ``order`` (long, not null), then
    ``ties`` (a hash, long); the last row is followed by the first.

    Rows go to as many ranges of (``order``, ``ties``) as there are shuffle partitions, in one
    exchange; a value of ``order`` that many rows share is spread over ranges by ``ties``.  The
    least row of each range also travels, marked, to the end of the range before it, so each range
    is complete by itself.  The driver sees one cut and one first place a range.  ``derived``
    columns are added once the travelling rows are chosen, so that they are not made twice.
    """
    spark = d.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = d.agg(F.percentile_approx(order, [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0]
    ranged = d.withColumn("__rng", _place(F.col(order), F.col(ties), sorted(cuts or [])))
    firsts = sorted((r[0], r[1][0], r[1][1]) for r in ranged.groupBy("__rng").agg(F.min(F.struct(order, ties))).collect())
    opens = [(key, tie, firsts[i - 1][0]) for i, (_, key, tie) in enumerate(firsts)]
    guests = spark.createDataFrame(opens, "__first long, __tie long, __to int")
    # rows of equal key and text are alike: one of them goes
    visiting = (d.join(F.broadcast(guests), (F.col(order) == F.col("__first")) & (F.col(ties) == F.col("__tie")))
                .groupBy(F.col("__to").alias("__rng")).agg(*[F.first(c).alias(c) for c in d.columns])
                .select(*d.columns, "__rng", F.lit(1).alias("__guest")))
    w = Window.partitionBy("__rng").orderBy("__guest", order, ties)
    return (ranged.withColumn("__guest", F.lit(0)).withColumns(derived or {})
            .unionByName(visiting.withColumns(derived or {}))
            .select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
            .filter("__guest = 0").drop("__rng", "__guest"))


def edit_likeness(docs: DataFrame, k: int = K, id_col: str = DOC_ID, text_col: str = "text") -> DataFrame:
    """Each text against its half-edited form and against the next document's text."""
    d = narrow(docs, id_col, text_col)
    d = d.select(DOC_ID, F.coalesce(F.col(DOC_ID).cast("long"), F.lit(-2 ** 63)).alias("__key"),
                 "text", F.xxhash64("text").alias("__th"))
    d = with_next(d, "__key", ["text", "sketch"], "__th", {"sketch": sketch(F.col("text"), k)})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    d = d.select(DOC_ID, n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    d = d.select("*", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), k).alias("edited_sketch"))
    a, e, nx = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return d.select(DOC_ID, "n_chars", "edited_sha256", fingerprint(a).alias("fingerprint"),
                    fingerprint(e).alias("edited_fingerprint"),
                    resemblance(a, e, k).alias("near_edited"), resemblance(a, nx, k).alias("near_next"),
                    distinct_shingles(a, k).alias("distinct_shingles"),
                    containment(a, e, k).alias("contained_in_edited"))
