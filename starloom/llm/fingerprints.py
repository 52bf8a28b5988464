"""Document fingerprints: one-permutation MinHash with optimal densification and b-bit packing, in DataFrame functions only.

The words of a text (lower-cased, split at U+0020 and U+0009-U+000D) give five-word shingles; fewer words are one shingle. Every shingle is hashed
once: the top 8 bits name its bin, the rest its value, and a bin keeps its least value. An empty bin takes the value of a bin that holds one,
found by a probe of its own: bin i tries (i + t * step(i)) mod BINS with an odd step, so it reaches every bin, and texts that share the borrowed
bin share the loan. Of each value BITS low bits are kept, 16 bins to a 64-bit number. Two unrelated bins agree by chance in one of 2^BITS
cases; likeness is the share of equal bins corrected for that, max(0, (m - 2^-BITS) / (1 - 2^-BITS)).

Null text is empty; a text without words has the empty fingerprint, of likeness 1 to another empty one and 0 to any other. The next document is
the one before in the order of doc_id, a null id counting as the smallest number (which stands for it and is no id itself) and texts of one id in the order of their hashes; rows that
repeat id and text are one document and get one result each. After the last comes the first; a single document follows itself. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import table

WIDTH = 5
BINS = 256
BITS = 4
PACKED = 64 // BITS
_LOWEST = -(1 << 63)
#: Ones at the lowest bit of each packed field.
_FIELDS = int("0001" * PACKED, 2)


def _step(i: int) -> int:
    """The odd step of bin i's probes."""
    return (i * 0x9E3779B1 >> 7) % BINS | 1


def _with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the packed fingerprint, an array of BINS / PACKED longs, empty for a text without words.

    Each step is a column that the next one reads more than once, so that the optimizer keeps them apart and computes each once.
    """
    words, hashes, slots, held, dense = (f"__{out}_{x}" for x in ("words", "hashes", "slots", "held", "dense"))
    top = 64 - (BINS - 1).bit_length()
    most = (1 << top) - 1
    df = df.withColumn(words, F.transform(F.filter(F.split(F.lower(text), "[ \\t-\\r]+"), lambda x: x != ""), lambda x: F.xxhash64(x)))
    shingles = F.transform(F.sequence(F.lit(0), F.size(words) - WIDTH), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WIDTH)]))
    short = F.array(F.xxhash64(*[F.get(words, F.lit(k)) for k in range(WIDTH)]))
    # The largest value of every bin goes in as well: after sorting, the first number of each bin is its least hash, or else this mark.
    marks = F.lit([((i - BINS // 2) << top) + most for i in range(BINS)])
    df = df.withColumn(hashes, F.when(F.size(words) > 0, F.sort_array(F.concat(F.when(F.size(words) >= WIDTH, shingles).otherwise(short), marks))).otherwise(F.array().cast("array<long>")))
    firsts = F.filter(hashes, lambda x, i: (i == 0) | (F.shiftright(x, top) != F.shiftright(F.get(F.col(hashes), F.greatest(i - 1, F.lit(0))), top)))
    value = lambda x: F.when(x.bitwiseAND(F.lit(most)) != most, x.bitwiseAND(F.lit((1 << BITS) - 1)))  # noqa: E731 - null in an empty bin
    df = df.withColumn(slots, F.transform(firsts, value))
    df = df.withColumn(held, F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.get(F.col(slots), i).isNotNull()))
    steps = F.lit([_step(i) for i in range(BINS)])
    backs = F.lit([pow(_step(i), -1, BINS) for i in range(BINS)])

    def dense_value(x: Column, i: Column) -> Column:
        def probe(t: Column) -> Column:
            return F.get(F.col(slots), F.pmod(i + t * F.get(steps, i), F.lit(BINS)))

        # The first probes one by one; then the probe that hits first, from the bins that hold a value.
        later = F.array_min(F.transform(F.col(held), lambda j: F.pmod((j - i) * F.get(backs, i), F.lit(BINS))))
        return F.coalesce(x, *[probe(F.lit(t)) for t in range(1, 7)], probe(later))

    df = df.withColumn(dense, F.when(F.size(held) > 0, F.transform(slots, dense_value)).otherwise(F.array().cast("array<long>")))
    packed = F.transform(F.sequence(F.lit(0), F.lit(BINS // PACKED - 1)), lambda k: F.aggregate(F.slice(F.col(dense), k * PACKED + 1, PACKED), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x)))
    return df.withColumn(out, F.when(F.size(dense) > 0, packed).otherwise(F.array().cast("array<long>"))).drop(words, hashes, slots, held, dense)


def as_text(packed: str) -> Column:
    """The fingerprint as lower-case hexadecimal digits."""
    return F.array_join(F.transform(packed, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Bias-corrected estimate of the Jaccard similarity behind two packed fingerprints."""
    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for shift in (1, 2):
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        return F.bit_count(z.bitwiseAND(F.lit(_FIELDS)))

    different = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    estimate = F.greatest(F.lit(0.0), (1 - different / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(estimate)


def _successors(keys: DataFrame) -> DataFrame:
    """(k, h, n, next_k, next_h) for distinct (k, h, n), where next is the neighbour in descending order of (k, h), the first after the last.

    Ranges of keys are sorted side by side; only the two ends of each range meet in one task.
    """
    ranged = keys.distinct().repartitionByRange("k", "h").withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    order = [F.desc("k"), F.desc("h")]
    inner = ranged.withColumn("next", F.lead(F.struct("k", "h")).over(Window.partitionBy("part").orderBy(*order)))
    ends = ranged.groupBy("part").agg(F.max(F.struct("k", "h")).alias("head"), F.min(F.struct("k", "h")).alias("tail"))
    whole = Window.orderBy(F.desc("part"))  # a row per range
    frame = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lead("head").over(whole), F.first("head").over(frame)).alias("after"))
    out = inner.join(F.broadcast(ends), "part").withColumn("next", F.coalesce("next", "after"))
    return out.select("k", "h", "n", F.col("next.k").alias("next_k"), F.col("next.h").alias("next_h"))


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of documents.

    Texts go through one exchange by key; what a document takes from the next one is cut where that one lies and sent as its own rows, at
    most a third of all text. Rows that repeat id and text would multiply heads; they are counted and heads made distinct.
    """
    body = F.coalesce("text", F.lit(""))
    # Both joins read the same three columns, so that they share one exchange of the texts.
    docs = documents.select(F.coalesce("doc_id", F.lit(_LOWEST)).alias("k"), F.xxhash64(body).alias("h"), body.alias("text"))
    after = materialize(_successors(docs.select("k", "h", F.char_length("text").cast("long").alias("n"))), "successors")
    wanted = after.select(F.col("next_k").alias("k"), F.col("next_h").alias("h"), F.col("k").alias("for_k"), F.col("h").alias("for_h"), F.floor(F.col("n") / 3).cast("int").alias("take"))
    heads = docs.join(wanted, ["k", "h"]).select(F.col("for_k").alias("k"), F.col("for_h").alias("h"), F.expr("left(text, take)").alias("head"))
    heads = heads.groupBy("k", "h").agg(F.min("head").alias("head"))
    own = docs.join(heads, ["k", "h"]).join(after, ["k", "h"])
    own = own.withColumn("edited", F.concat(F.expr("left(text, cast(n - floor(n / 3) as int))"), "head")).drop("head")
    own = _with_fingerprint(_with_fingerprint(own, "text", "own"), "edited", "changed")
    own = own.select(F.nullif("k", F.lit(_LOWEST)).alias("doc_id"), "k", "h", "n", "next_k", "next_h", F.sha2("edited", 256).alias("edited_sha256"), "own", "changed")
    own = materialize(own, "fingerprints")
    following = own.groupBy(F.col("k").alias("next_k"), F.col("h").alias("next_h")).agg(F.first("own").alias("following"))
    out = own.join(following, ["next_k", "next_h"])
    return out.select(
        "doc_id", F.col("n").alias("n_chars"), "edited_sha256", as_text("own").alias("fingerprint"), as_text("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "following").alias("near_next"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
