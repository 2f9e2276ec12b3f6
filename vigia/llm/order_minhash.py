"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text's pieces are its runs of non-white-space, cut after ``PIECE``
characters; its k-mers are ``K`` pieces in a row, each numbered by how often it
occurred before in the text, so that all (k-mer, number) pairs differ.  Their
hashes are dealt to ``SLOTS`` equal ranges.  Of each range the two smallest are
kept *in the order they have in the text* and hashed as a tuple: one slot of
the fingerprint.  Two texts agree in a slot if their minima agree and stand in
the same order, so insertions, replacements and moves all show.

Everything of a text happens in its own row (no row per k-mer): an array of
(hash, place) packed into longs is sorted twice, once to number repeats and
once to find the minima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import free_name, text_or_empty

K, SLOTS, PIECE = 3, 64, 12
#: Bits of a place in the packed longs; pieces beyond 2^24 share the last place.
PLACE = 24
_MASK = (1 << PLACE) - 1
_SLOT_BITS = SLOTS.bit_length() - 1


def _hash(x: Column) -> Column:
    return F.shiftright(x, PLACE)


def _label(x: Column, number: Column) -> Column:
    """(k-mer hash, place) -> (hash of k-mer and its number, place)."""
    return (F.xxhash64(_hash(x), number).bitwiseAND(F.lit(~_MASK).cast("long"))
            .bitwiseOR(x.bitwiseAND(F.lit(_MASK).cast("long"))))


def _slot(x: Column) -> Column:
    return F.shiftright(x, 64 - _SLOT_BITS) + SLOTS // 2


def _tuple(a: Column, b: Column) -> Column:
    """Hash of two minima in text order."""
    place = lambda x: x.bitwiseAND(F.lit(_MASK).cast("long"))
    return F.when(place(a) <= place(b), F.xxhash64(_hash(a), _hash(b))).otherwise(F.xxhash64(_hash(b), _hash(a)))


def with_slots(df: DataFrame, text_col: str, out_col: str = "slots") -> DataFrame:
    """``df`` with ``out_col`` array<int> of SLOTS slots, null where a range
    holds no k-mer.  Fewer pieces than K: one k-mer of all of them; null, empty
    and blank texts: all null."""
    pieces, kmers, packed, starts, labels, minima, tuples = (
        free_name(df, f"_{out_col}_{x}") for x in ("pieces", "kmers", "packed", "starts", "labels", "minima", "tuples"))
    c, n = F.col, F.size(F.col(pieces))
    none = F.array().cast("array<bigint>")
    df = df.withColumn(pieces, F.regexp_extract_all(text_or_empty(text_col), F.lit(rf"(\S{{1,{PIECE}}})"), F.lit(1)))
    neighbours = F.arrays_zip(*[F.slice(c(pieces), i + 1, F.greatest(n - (K - 1), F.lit(0))).alias(f"p{i}")
                                for i in range(K)])
    df = df.withColumn(kmers, F.when(n >= K, F.transform(
        neighbours, lambda x: F.xxhash64(*[x[f"p{i}"] for i in range(K)])))
        .when(n > 0, F.array(F.xxhash64(c(pieces)))).otherwise(none))
    # sorted by (hash, place): repeats of a k-mer stand together, in text order
    df = df.withColumn(packed, F.sort_array(F.transform(c(kmers), lambda x, i: (
        x.bitwiseAND(F.lit(~_MASK).cast("long")).bitwiseOR(F.least(i, F.lit(_MASK)).cast("long"))))))
    df = df.withColumn(starts, F.when(F.size(packed) > 0, F.filter(
        F.sequence(F.lit(0), F.size(packed) - 1),
        lambda i: (i == 0) | (_hash(F.get(c(packed), i)) != _hash(F.get(c(packed), i - 1)))))
        .otherwise(F.array().cast("array<int>")))
    df = df.withColumn(labels, F.sort_array(
        F.when(F.size(starts) == F.size(packed), F.transform(c(packed), lambda x: _label(x, F.lit(0))))
        .otherwise(F.flatten(F.transform(c(starts), lambda s, r: F.transform(
            F.sequence(F.lit(0), F.coalesce(F.get(c(starts), r + 1), F.size(packed)) - 1 - s),
            lambda o: _label(F.get(c(packed), s + o), o)))))))
    # the two smallest of every range
    df = df.withColumn(minima, F.filter(c(labels), lambda x, i: (
        (i < 2) | (_slot(F.get(c(labels), i - 2)) != _slot(x)))))
    ranges = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    full = F.transform(ranges, lambda b: _tuple(F.get(c(minima), 2 * b), F.get(c(minima), 2 * b + 1)))
    some = F.transform(F.transform(ranges, lambda b: F.filter(c(minima), lambda x: _slot(x) == b)),
                       lambda own: F.when(F.size(own) == 2, _tuple(own[0], F.get(own, F.lit(1))))
                       .when(F.size(own) == 1, F.xxhash64(_hash(own[0]))))
    df = df.withColumn(tuples, F.when(F.size(minima) == 2 * SLOTS, full)
                       .when(F.size(minima) > 0, some).otherwise(F.array_repeat(F.lit(None).cast("long"), SLOTS)))
    return (df.withColumn(out_col, F.transform(c(tuples), lambda x: F.shiftright(x, 32).cast("int")))
            .drop(pieces, kmers, packed, starts, labels, minima, tuples))


def as_text(slots: Column) -> Column:
    """Eight hex digits a slot; dashes for a null one."""
    return F.array_join(F.transform(slots, lambda x: F.coalesce(
        F.lower(F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), 8, "0")),
        F.lit("-" * 8))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of text that two fingerprints have in common, 0 to 1.

    Of the slots that either has, the share r that agrees estimates the chance
    that both minima do; j = sqrt(r) is that of one, the share of all k-mers
    that are common, and 2 j / (1 + j) the share of a text's own.  Two empty
    fingerprints are equal: 1."""
    alike = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda z: F.coalesce(z, F.lit(False))))
    used = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x, y)), lambda z: z.isNotNull()))
    j = F.sqrt(alike / F.greatest(used, F.lit(1)))
    return F.when(used == 0, F.lit(1.0)).otherwise(2 * j / (1 + j))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and fingerprint."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return with_slots(rows, "text").select("doc_id", as_text(F.col("slots")).alias("fingerprint"))


def _tree(key: Column, bounds: list, at: int = 0) -> Column:
    """Number of bounds smaller than key, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(at)
    mid = len(bounds) // 2
    return F.when(key > F.lit(bounds[mid]), _tree(key, bounds[mid + 1:], at + mid + 1)).otherwise(
        _tree(key, bounds[:mid], at))


def with_next(rows: DataFrame, key: str, carried: list[str], tie: str) -> DataFrame:
    """``rows`` with ``next_<c>`` of every carried column: its value in the row
    after this one by descending ``key`` (nulls last, then ``tie``; after the
    last row: the first).

    Rows are dealt to ranges of the key whose bounds are keys that occur.  A
    bound is its range's largest key, so its row is also the row after the last
    of the range above, and is sent there as well; only the bounds are
    collected.  A key that a third of all rows share makes one range large."""
    spark = rows.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    points = [i / ranges for i in range(1, ranges)] or [0.5]
    found = rows.agg(F.max(key).alias("last"), F.percentile_approx(key, points).alias("bounds")).first()
    bounds = sorted(set(found["bounds"] or []))
    of, sent, last = (free_name(rows, c) for c in ("_range", "_sent", "_last"))
    own = F.coalesce(_tree(F.col(key), bounds), F.lit(0))
    also = F.coalesce(F.col(key).isin(bounds), F.lit(False)) if bounds else F.lit(False)
    is_first = F.col(key).eqNullSafe(F.lit(found["last"]))
    copies = F.filter(F.array(
        F.struct(own.alias("r"), F.lit(0).alias("kind")),
        F.when(also, F.struct((own + 1).alias("r"), F.lit(1).alias("kind"))),
        F.when(is_first, F.struct(F.lit(0).alias("r"), F.lit(2).alias("kind")))), lambda x: x.isNotNull())
    dealt = (rows.withColumn(of, F.explode(copies)).withColumn(sent, F.col(f"{of}.kind"))
             .withColumn(of, F.col(f"{of}.r")))
    order = Window.partitionBy(of).orderBy(F.col(sent) == 2, F.col(key).desc_nulls_last(), tie, sent)
    return (dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
            .where(F.col(sent) == 0).drop(of, sent))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) code points replaced by the
    first as many (or all) of the next row's text, by descending id.  Null
    texts are read as empty; rows with a null id come last; rows that repeat an
    id follow each other by their text's hash; a single row is its own next;
    an empty table gives no rows; other columns are not read."""
    rows = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
            .withColumn("text_hash", F.xxhash64("text")))
    dealt = with_next(with_slots(rows, "text"), "doc_id", ["text", "slots"], "text_hash")
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = (dealt.withColumn("n_chars", n.cast("long"))
              .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - cut),
                                             F.substring(F.col("next_text"), F.lit(1), cut)))
              .drop("text", "next_text"))
    both = with_slots(edited, "edited", "edited_slots")
    return both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       as_text(F.col("slots")).alias("fingerprint"),
                       as_text(F.col("edited_slots")).alias("edited_fingerprint"),
                       likeness(F.col("slots"), F.col("edited_slots")).alias("near_edited"),
                       likeness(F.col("slots"), F.col("next_slots")).alias("near_next"))
