"""Document fingerprints from closed syncmers (operator 11, built-in functions only).

A k-mer of a text is chosen if the least of its inner s-mers, by hash, is its
first or its last one.  The choice depends on the k-mer alone, so equal
passages of two texts choose the same k-mers, wherever they stand.  A
fingerprint keeps the chosen k-mers of least hash with their places; two
fingerprints are compared by the k-mers they share in consistent places.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import sha, stored, text_or_empty
from wardline.llm.quality import let

#: characters of a k-mer and of its inner s-mers
K, S = 16, 9
#: the least s-mer of a chosen k-mer is below this, which is above every hash:
#: no closed syncmer is left out
LOW = 1 << 63
#: anchors that a fingerprint keeps
KEEP = 64
#: an anchor is a number of 38 bits of hash over 24 bits of place
HASH_BITS, PLACE_BITS = 38, 24
#: characters of a text that are worked on at once
PIECE = 4096
#: characters of a block of neighbouring documents, and blocks at most
BLOCK_CHARS, MOST_BLOCKS = 1 << 20, 250_000
#: more equal rows than this, and than one in 100,000, travel as one
HOT_ROWS, HOT_SHARE = 1000, 100_000


def anchor(code: Column, place: Column) -> Column:
    bits = F.xxhash64(code).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    return F.shiftleft(bits, PLACE_BITS).bitwiseOR(F.least(place, F.lit((1 << PLACE_BITS) - 1)).cast("long"))


def closed_syncmers(piece: Column, first: Column, k: int, s: int) -> Column:
    """Anchors of the chosen k-mers of ``piece`` (four bytes a character),
    ``first`` the place of its first character.

    Every s-mer is hashed once; the least of each k-mer's s-mers comes from
    running minima whose reach doubles.
    """
    reach = k - s
    part = lambda i, n: F.substring(piece, i * 4 + 1, F.lit(4 * n))

    def minima(values: Column, wide: int, use) -> Column:  # of ``wide`` values on, as a power of two allows
        if 2 * wide > reach + 1:
            return use(values, wide)
        later = F.slice(values, wide + 1, F.size(values))
        return let(F.zip_with(values, later, lambda x, y: F.least(x, y)), lambda both: minima(both, 2 * wide, use))

    def chosen(values: Column) -> Column:
        def of(least: Column, wide: int) -> Column:
            def closed(i: Column) -> Column:
                low = F.get(least, i) if wide == reach + 1 else F.least(F.get(least, i), F.get(least, i + (reach + 1 - wide)))
                return low == F.least(F.get(values, i), F.get(values, i + reach))

            return F.transform(F.filter(F.sequence(F.lit(0), F.size(values) - 1 - reach), closed), lambda i: anchor(part(i, k), first + i))

        return minima(values, 1, of)

    return let(F.transform(F.sequence(F.lit(0), (F.length(piece) / 4).cast("int") - s), lambda i: F.xxhash64(part(i, s))), chosen)


def anchors(text: Column, first: Column, k: int, s: int) -> Column:
    """All anchors of a text, ascending.  Long texts are cut into pieces that
    overlap by ``k - 1`` characters, which the choice cannot tell from the whole."""
    def of(code: Column, first: Column) -> Column:
        n = (F.length(code) / 4).cast("int")
        starts = F.when(n >= k, F.sequence(F.lit(0), F.greatest(n - k, F.lit(0)), F.lit(PIECE))).otherwise(F.array().cast("array<int>"))
        return F.sort_array(F.flatten(F.transform(starts, lambda at: let(
            F.substring(code, at * 4 + 1, F.lit(4 * (PIECE + k - 1))), lambda piece: closed_syncmers(piece, first + at, k, s)))))

    return let(F.encode(text, "UTF-32"), lambda code: let(first, lambda at: of(code, at)))  # both once a text


def least_of(found: Column, keep: int) -> Column:
    """The ``keep`` first of ascending anchors, one of each hash."""
    other = lambda a: F.filter(a, lambda x, i: (i == 0) | (F.shiftright(x, PLACE_BITS) != F.shiftright(F.get(a, i - 1), PLACE_BITS)))
    return F.slice(let(found, other), 1, keep)


def or_whole(prints: Column, text: Column) -> Column:
    """A text without a syncmer has one anchor, of all its characters; an empty
    text has none."""
    whole = anchor(F.encode(text, "UTF-32"), F.lit(0))
    return let(prints, lambda x: F.when((F.size(x) > 0) | (text == ""), x).otherwise(F.array(whole)))


def fingerprint(text: Column, k: int = K, s: int = S, keep: int = KEEP) -> Column:
    """The ``keep`` least anchors of different hash, ascending."""
    return or_whole(least_of(anchors(text, F.lit(0), k, s), keep), text)


def shown(prints: Column) -> Column:
    """16 hexadecimal digits an anchor."""
    return F.array_join(F.transform(prints, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column, keep: int = KEEP) -> Column:
    """Shared anchors over all anchors of two fingerprints (Dice), 0 to 1.

    Only hashes that both fingerprints reach down to are counted.  A shared
    anchor counts if it stands at the same place in both, or moved as far as
    the shared anchor before or after it; others are chance.  Two empty
    fingerprints are alike, an empty one and another are not.
    """
    high = lambda x: F.shiftright(x, PLACE_BITS)
    reach = lambda x: F.when(F.size(x) < keep, F.lit(1 << HASH_BITS)).otherwise(high(F.element_at(x, -1)))
    place = lambda x: F.shiftright(x, 1).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    head, tail = (lambda x: F.slice(x, 1, F.size(x) - 1)), (lambda x: F.slice(x, 2, F.size(x) - 1))

    def pair(x: Column, y: Column) -> Column:  # neighbours in hash order; the last bit tells the side
        p, q = place(x), place(y)
        left = x.bitwiseAND(F.lit(1)) == 0
        return F.when(F.shiftright(x, PLACE_BITS + 1) == F.shiftright(y, PLACE_BITS + 1),
                      F.struct(F.when(left, p).otherwise(q).alias("at"), F.when(left, q - p).otherwise(p - q).alias("moved")))

    def consistent(m: Column) -> Column:
        near = lambda x, y: F.coalesce(x["moved"] == y["moved"], F.lit(False))
        return F.size(F.filter(m, lambda x, i: (x["moved"] == 0) | near(x, F.get(m, i - 1)) | near(x, F.get(m, i + 1))))

    def counted(both: Column) -> Column:
        matches = F.sort_array(F.array_compact(F.zip_with(head(both), tail(both), pair)))
        return F.when(F.size(both) < 2, F.lit(0.0)).otherwise(let(matches, consistent) * 2.0 / F.size(both))

    def compared(limit: Column) -> Column:
        side = lambda x, bit: F.transform(F.filter(x, lambda v: high(v) <= limit), lambda v: F.shiftleft(v, 1).bitwiseOR(F.lit(bit).cast("long")))
        return let(F.sort_array(F.concat(side(a, 0), side(b, 1))), counted)

    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(let(F.least(reach(a), reach(b)), compared)))


def with_next(rows: DataFrame, values: list[str]) -> DataFrame:
    """``rows`` (``_id, _digest, _text`` and more) with ``_next_<value>`` of the
    row that follows by descending id, then digest; the first follows the last.
    Rows without an id come last.

    The order is cut into blocks at rows that their digest picks, wherever
    they stand; a block's first row also travels to the block before it.  So
    one shuffle of the texts finds every neighbour, and no task holds the
    whole order.
    """
    spark = rows.sparkSession
    keys = stored(rows.select("_id", "_digest", F.length("_text").cast("long").alias("_size")), "neighbour-keys")
    key = F.struct("_id", "_digest")
    total = keys.agg(F.count("*").alias("n"), F.sum("_size").alias("chars")).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max((total["chars"] or 0) // BLOCK_CHARS, 4 * partitions)
    step = max(total["n"] // max(min(wanted, MOST_BLOCKS, total["n"] // 8), 1), 1)
    highest, ks = F.max(key).alias("top"), F.reverse(F.sort_array(F.collect_set(
        F.when(F.pmod(F.xxhash64("_digest", "_id"), F.lit(step)) == 0, key)))).alias("ks")
    # about MOST_BLOCKS small keys at most, as a constant of the plan: lists of a few hundred
    width = max(math.isqrt(min(wanted, MOST_BLOCKS)), 1)
    cuts = keys.agg(highest, ks).select("top", F.filter("ks", lambda k: k < F.col("top")).alias("ks")).select(
        "top", F.size("ks").alias("last"), F.transform(F.filter(F.sequence(F.lit(0), F.size("ks"), F.lit(width)), lambda i: i < F.size("ks")),
                                                       lambda i: F.slice(F.col("ks"), i + 1, F.lit(width))).alias("lists"))
    found = cuts.select(F.to_json(F.struct("*"))).first()[0]
    constant = F.from_json(F.lit(found), cuts.schema)
    highest, last, nested = constant["top"], constant["last"], constant["lists"]

    def block(ls: Column) -> Column:
        """(cuts at or above the key, whether the key is a cut)."""
        g = F.size(F.filter(ls, lambda l: l[0] >= key))
        inside = let(F.get(ls, g - 1), lambda l: F.struct(
            (F.size(F.filter(l, lambda c: c >= key)) + (g - 1) * width).alias("no"), F.exists(l, lambda c: c == key).alias("cut")))
        return F.when(g == 0, F.struct(F.lit(0).alias("no"), F.lit(False).alias("cut"))).otherwise(inside)

    placed = rows.withColumn("_b", block(nested))
    guest = F.when(F.col("_b.cut"), F.col("_b.no") - 1).when(key == highest, last)
    at = lambda no, visits: F.struct(no.alias("no"), F.lit(visits).alias("guest"))
    sent = placed.withColumn("_at", F.explode(F.array_compact(F.array(at(F.col("_b.no"), False), F.when(guest.isNotNull(), at(guest, True))))))
    own = Window.partitionBy("_at.no").orderBy(F.col("_at.guest"), F.col("_id").desc_nulls_last(), F.desc("_digest"))
    nexts = [F.lead(v).over(own).alias(f"_next{v}") for v in values]
    return sent.select("*", *nexts).where(~F.col("_at.guest")).drop("_b", "_at")


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S, keep: int = KEEP) -> DataFrame:
    """Fingerprints of each text and of its edited text, and likenesses.

    The edited text has its last half replaced by the start of the next
    document by descending id (after the last, the first; alone, itself).  A
    null text is empty; rows without an id come last; rows with one id follow
    each other by the digest of their text; repeated rows are each reported;
    an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), text_or_empty(f"`{text_col}`").alias("_text"))
    rows = rows.withColumn("_digest", F.xxhash64("_text")).withColumn("_copies", F.lit(1).cast("long"))
    equal = rows.groupBy("_id", "_digest").agg(F.count("*").alias("_n"))
    size = F.greatest(F.lit(HOT_ROWS), F.lit(rows.count() // HOT_SHARE))
    hot = stored(equal.where(F.col("_n") > size).select(F.col("_id").alias("_hot"), F.col("_digest").alias("_hot_digest")), "equal-rows")
    if not hot.isEmpty():  # at most HOT_SHARE keys
        is_hot = rows["_id"].eqNullSafe(hot["_hot"]) & (rows["_digest"] == hot["_hot_digest"])
        one = (rows.join(F.broadcast(hot), is_hot, "left_semi").groupBy("_id", "_digest")
               .agg(F.max("_text").alias("_text"), F.count("*").alias("_copies")))
        rows = rows.join(F.broadcast(hot), is_hot, "left_anti").unionByName(one)
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    front = n - half
    # the choice of a k-mer is free of context: anchors of the kept half stay those of the edited text
    inside = let(front - k, lambda last: F.filter("_all", lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) <= last))
    long_text = n >= 1 << PLACE_BITS  # places are exact below this length only
    rows = rows.withColumn("_all", anchors(F.col("_text"), F.lit(0), k, s)).select(
        "_id", "_digest", "_text", "_copies", or_whole(least_of(F.col("_all"), keep), F.col("_text")).alias("_print"),
        F.when(~long_text, least_of(inside, keep)).alias("_front"))
    rows = with_next(rows, ["_text", "_print"])

    # rows that travel as one: all but the last are followed by themselves
    follower = F.struct(F.lit(1).cast("long").alias("n"), F.col("_next_text").alias("text"), F.col("_next_print").alias("print"))
    itself = F.struct((F.col("_copies") - 1).alias("n"), F.col("_text").alias("text"), F.col("_print").alias("print"))
    each = rows.withColumn("_f", F.explode(F.array_compact(F.array(follower, F.when(F.col("_copies") > 1, itself)))))
    edited = F.concat(F.substring("_text", F.lit(1), front), F.substring("_f.text", F.lit(1), half))
    each = each.select("_id", "_print", "_front", "_f", n.cast("long").alias("n_chars"), edited.alias("_edited"),
                       F.when(F.col("_front").isNull(), 0).otherwise(F.greatest(front - (k - 1), F.lit(0))).alias("_from"))
    rest = anchors(F.substring("_edited", F.col("_from") + 1, F.length("_edited")), F.col("_from"), k, s)
    joined = F.sort_array(F.concat(F.coalesce("_front", F.array().cast("array<long>")), rest))
    each = each.select("*", or_whole(least_of(joined, keep), F.col("_edited")).alias("_edited_print"))
    result = each.select(
        F.col("_id").alias(id_col), "n_chars", sha(F.col("_edited")).alias("edited_sha256"), shown(F.col("_print")).alias("fingerprint"),
        shown(F.col("_edited_print")).alias("edited_fingerprint"), likeness(F.col("_print"), F.col("_edited_print"), keep).alias("near_edited"),
        likeness(F.col("_print"), F.col("_f.print"), keep).alias("near_next"), F.col("_f.n").alias("_n"))
    return result.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("_n")
