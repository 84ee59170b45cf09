"""Lookups: address ranges, and joins whose fact side has hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import once

# Fixed value: four numbers from 0 to 255, with dots between.
_IPV4 = r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$"


def ipv4_number(c: Column | str) -> Column:
    """IPv4 text to a number; NULL for anything else, IPv6 included, which is placed nowhere."""
    text = F.col(c) if isinstance(c, str) else c
    number = F.aggregate(F.split(text, r"\."), F.lit(0).cast("long"), lambda acc, x: acc * 256 + x.cast("long"))
    return F.when(text.rlike(_IPV4), number)


def near(df: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """The rows of a large table that belong to some ids.

    Without a hint: Spark broadcasts the ids while they are small, so the large table is
    cut down where it is read.
    """
    return df.join(ids.select(*keys), list(keys), "left_semi")


def salted_join(fact: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "left", salts: int = 16,
                spread_by: Sequence[str] = ()) -> DataFrame:
    """Equi-join of a large side with hot keys to a lookup side.

    The fact rows of a hot key are spread over ``salts`` tasks by a hash of
    ``spread_by`` (a column that differs between them, e.g. the row id) and its lookup
    rows are repeated as often.  A key is hot if it has more fact rows than an average shuffle partition, so there are
    fewer hot keys than partitions; the lookup rows of all others are there once.  Fact rows without a full key match
    nothing and are spread as well.  The result is the same for any salt.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("a salted join keeps the fact side: inner, left, left_semi or left_anti")
    spark, n = fact.sparkSession, "__key_rows"
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counted = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    fair = max(1, fact.count() // int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = counted.filter(~no_key & (F.col(n) > fair)).select(*keys, F.lit(salts).cast("long").alias("__salts"))
    hot = F.broadcast(spark.createDataFrame(found.collect(), found.schema))  # fewer rows than partitions
    salt = F.pmod(F.xxhash64(*(spread_by or fact.columns)), F.when(no_key, F.lit(salts).cast("long")).otherwise(F.coalesce("__salts", F.lit(1))))
    spread = fact.join(hot, list(keys), "left").withColumn("__salt", salt).drop("__salts")
    repeated = (lookup.join(hot, list(keys), "left")
                .withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts"))
    return spread.join(repeated, [*keys, "__salt"], how).drop("__salt")


def range_blocks(ranges: DataFrame, low: str = "lo", high: str = "hi") -> DataFrame:
    """Each range with its level and the blocks of that level it touches, three at most.

    A block of level n has 16^n numbers, and a range is kept at the first level whose blocks are as long
    as it is.  So a wide range is not spread over many blocks, and ranges that do not overlap are
    at most about twenty to a block, as all of a level are longer than a sixteenth of it.
    """
    length = (F.col(high).cast("decimal(20,0)") - F.col(low) + 1).cast("double")
    level = F.least(F.lit(15), F.greatest(F.lit(0), F.ceil(F.log2(length) / 4))).cast("int")
    blocks = F.expr(f"sequence(shiftright(CAST(`{low}` AS BIGINT), 4 * __level), shiftright(CAST(`{high}` AS BIGINT), 4 * __level))")
    return (ranges.filter(F.col(low) <= F.col(high)).withColumn("__level", level).withColumn("__block", F.explode(blocks)))


def _in_ranges(numbers: DataFrame, number: str, ranges: DataFrame, low: str, high: str) -> DataFrame:
    """Inner join to the range that holds each number, by equality on level and block."""
    levels = F.explode(F.sequence(F.lit(0), F.lit(15)))
    keyed = numbers.withColumn("__level", levels).withColumn(
        "__block", F.expr(f"shiftright(CAST(`{number}` AS BIGINT), 4 * __level)"))
    blocks = range_blocks(ranges, low, high)
    there = [r[0] for r in blocks.select("__level").distinct().collect()]  # 16 at most
    hit = F.col(number).between(F.col(low), F.col(high))
    return keyed.filter(F.col("__level").isin(there)).join(blocks, ["__level", "__block"]).filter(hit).drop("__level", "__block")


def range_lookup(fact: DataFrame, number: str, ranges: DataFrame, low: str = "lo", high: str = "hi") -> DataFrame:
    """Left join of each number to the range that holds it; ranges must not overlap.

    The distinct numbers are looked up and the answer is joined back, so a number seen a
    billion times costs one range test.  Both joins are plain equi-joins: small lookup
    sides are broadcast by Spark once it knows their size, larger ones are shuffled and
    skewed partitions split.
    """
    numbers = fact.select(F.col(number).alias("__number")).filter(F.col(number).isNotNull()).distinct()
    found = _in_ranges(numbers, "__number", ranges, low, high)
    return fact.join(found, fact[number] == found["__number"], "left").drop("__number")


def ip_place(fact: DataFrame, ip: str, ranges: DataFrame, places: Sequence[str]) -> DataFrame:
    """Add the place columns of an IPv4 text from a range table ``(lo, hi, ..)``; NULL if unknown.

    Addresses are made distinct as text, so each is parsed and looked up once.
    """
    seen = fact.select(F.col(ip).alias("__ip")).filter(F.col("__ip").isNotNull()).distinct()
    placed = _in_ranges(seen.withColumn("__n", ipv4_number("__ip")), "__n", ranges.select("lo", "hi", *places), "lo", "hi")
    placed = placed.select("__ip", *places)
    return fact.join(placed, fact[ip] == placed["__ip"], "left").drop("__ip")


_GROUP = r"^[0-9A-Fa-f]{1,4}$"


def address_bits(c: Column | str) -> Column:
    """An IPv4 address as 32, an IPv6 address as 128 characters 0 and 1; NULL for anything else.

    IPv6 may be shortened by ``::`` and may end in an IPv4 address; one that maps an IPv4 address (``::ffff:1.2.3.4``) is
    that address.  Zones (``%eth0``) are not part of an address: NULL.
    """
    def groups(half: Column) -> Column:
        return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":"))

    def filled(halves: Column) -> Column:
        """The eight groups; some other number of them if the text is no address."""
        left, right, parted = groups(F.get(halves, F.lit(0))), groups(F.coalesce(F.get(halves, F.lit(1)), F.lit(""))), F.size(halves) == 2
        zeros = F.when(parted, F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0))).otherwise(0)
        whole = F.concat(left, F.array_repeat(F.lit("0"), zeros), right)
        return F.when((F.size(halves) == 1) | (parted & (zeros > 0)), whole).otherwise(F.array().cast("array<string>"))

    def as_bits(eight: Column) -> Column:
        fits = (F.size(eight) == 8) & F.forall(eight, lambda g: g.rlike(_GROUP))
        return F.when(fits, F.array_join(F.transform(eight, lambda g: F.lpad(F.conv(g, 16, 2), 16, "0")), ""))

    def without_map(bits: Column) -> Column:
        return F.when(bits.startswith("0" * 80 + "1" * 16), F.substring(bits, 97, 32)).otherwise(bits)

    def six(text: Column) -> Column:
        def spelled(tail: Column) -> Column:
            low = [F.lower(F.hex(n)) for n in (F.shiftright(tail, 16), tail.bitwiseAND(F.lit(65535)))]
            return F.when(text.contains("."), F.concat(F.regexp_replace(text, r"[^:]*$", ""), low[0], F.lit(":"), low[1])).otherwise(text)

        plain = once(ipv4_number(F.substring_index(text, ":", -1)), spelled)
        return once(once(once(F.split(plain, "::"), filled), as_bits), without_map)

    text = F.col(c) if isinstance(c, str) else c
    four = F.lpad(F.conv(ipv4_number(text).cast("string"), 10, 2), 32, "0")
    return F.when(text.contains(":"), six(text)).otherwise(four)


def network_bits(c: Column | str) -> Column:
    """Of a network ``address/length``: a struct of the family's ``width`` in bits and its ``prefix`` of 0 and 1; NULL if it is none."""
    text = F.col(c) if isinstance(c, str) else c
    bits = address_bits(F.substring_index(text, "/", 1))
    length = F.substring_index(text, "/", -1).try_cast("int")
    known = text.rlike(r"^[^/]+/\d{1,3}$") & bits.isNotNull() & length.between(0, F.length(bits))
    return F.when(known, F.struct(F.length(bits).alias("width"), F.substring(bits, F.lit(1), length).alias("prefix")))


def network_place(fact: DataFrame, ip: str, networks: DataFrame, places: Sequence[str], network: str = "network") -> DataFrame:
    """Add the place columns of an address of either family from a table of networks; the longest network that holds it counts.

    Equality on family and prefix, once for each prefix length that occurs (161 at most), so no task compares addresses with ranges.
    Addresses are made distinct as text, so each is parsed and looked up once.  Of equal networks the one with the smallest places counts; texts
    that are no address and networks that are none match nothing.
    """
    known = (networks.select(network_bits(network).alias("__net"), F.struct(*places).alias("__place")).filter("__net is not null")
             .groupBy(F.col("__net.width").alias("__width"), F.col("__net.prefix").alias("__prefix")).agg(F.min("__place").alias("__place")))
    lengths = [tuple(r) for r in known.select("__width", F.length("__prefix").alias("n")).distinct().collect()]
    tries = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(n).alias("n")) for w, n in sorted(lengths)]) if lengths else F.array().cast("array<struct<w:int,n:int>>")
    seen = fact.select(F.col(ip).alias("__ip")).filter(F.col("__ip").isNotNull()).distinct().withColumn("__bits", address_bits("__ip"))
    tried = (seen.filter("__bits is not null").withColumn("__try", F.explode(tries)).filter("length(__bits) = __try.w")
             .select("__ip", F.col("__try.w").alias("__width"), F.substring("__bits", F.lit(1), F.col("__try.n")).alias("__prefix")))
    best = tried.join(known, ["__width", "__prefix"]).groupBy("__ip").agg(F.max_by("__place", F.length("__prefix")).alias("__place"))
    return fact.join(best, fact[ip] == best["__ip"], "left").select(fact["*"], *[F.col(f"__place.{p}").alias(p) for p in places])


def overlapping_ranges(ranges: DataFrame, low: str = "lo", high: str = "hi") -> DataFrame:
    """Ranges that start before an earlier one of the table has ended; empty for a usable table.

    Every start is looked up among the ranges, so no task sees all of them.
    """
    spans = ranges.groupBy(low, high).agg(F.count(F.lit(1)).alias("__n"))
    starts = spans.select(F.col(low).alias("__lo"), F.col(high).alias("__hi"), "__n")
    held = _in_ranges(starts, "__lo", spans.select(low, high), low, high)
    earlier = (F.col(low) < F.col("__lo")) | ((F.col(low) == F.col("__lo")) & (F.col(high) < F.col("__hi")))
    late = held.filter(earlier | (F.col("__n") > 1)).select(F.col("__lo").alias(low), F.col("__hi").alias(high)).distinct()
    return ranges.join(late, [low, high], "left_semi").select(*ranges.columns).distinct()
