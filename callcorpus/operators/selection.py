"""The k-th row of an order by counting key ranges (behind T1, T2, L1, W1 and paging).

Spark has no row order, and neither a global sort nor an unpartitioned window is needed to cut
a table at a position. Order columns of any simple type become one text, ``order_key``, whose
byte order is the wanted order (descending columns and NULLs included). ``kth`` then narrows
the keys down pass by pass:

1. least and greatest key and the count of the rows that are left: their common beginning
   says nothing, so it is skipped;
2. rows per value of the next characters, as many as have about ``RANGES`` values at most
   (estimated by a sketch); the counts reach the driver, and the one range that holds the
   k-th row is left.

Two or three rounds do for any table. When at most ``SMALL`` rows are left, they are ordered.
Only key columns are read, nothing is written or checkpointed, and every pass is a plain
aggregate: a lost executor costs its tasks only.

Before that, ``located`` narrows a large table column by column with the columns as they are:
a column of few values by counting them, a number of many values by approximate quantiles whose
exact ranks are then counted. Texts are made, and compared, only for the rows in that span. A
page near the beginning is one bounded sort.

``cut`` makes the first k rows of it, exactly: where rows share the k-th key, they are selected
by a digest of all their columns, and rows that are equal in every column are interchangeable
and given out by number.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.text import keep_where, let

#: Characters of the key that one pass may count, and the ranges it may make.
WIDTHS = (1, 3, 6, 12)
RANGES = 5_000
#: Rows that are ordered at the end.
SMALL = 20_000
#: Characters that divide a range when every row is numbered.
WIDTH = 3
#: Rows that one task ranks when every row is numbered.
RANGE_ROWS = 1_000_000
#: Rows up to which a page is cut by one sort that keeps as many rows per task.
SHALLOW = 1_000
#: Values of a column up to which each is counted by itself.
VALUES = 50_000
#: Share of the rows on either side of a quantile that is read as text.
MARGIN = 0.002

_HEX, _XEH = "0123456789ABCDEF", "FEDCBA9876543210"


@dataclass(frozen=True)
class Key:
    """An order column. ``nulls_first`` defaults to Spark's rule (first when ascending).
    ``raw``: a text of upper-case hexadecimal digits, of one length, taken as it is."""

    col: Column | str
    desc: bool = False
    nulls_first: bool | None = None
    raw: bool = False

    @property
    def expr(self) -> Column:
        return F.col(self.col) if isinstance(self.col, str) else self.col


def desc(col: Column | str) -> Key:
    return Key(col, True)


def keys_of(order_by: Sequence[Key | Column | str]) -> list[Key]:
    out = []
    for k in order_by:
        if isinstance(k, Column) and (" NULLS FIRST" in str(k) or " NULLS LAST" in str(k)):
            raise TypeError("pass a descending column as selection.desc(column)")
        out.append(k if isinstance(k, Key) else Key(k))
    return out


def _long_digits(x: Column) -> Column:
    return F.lpad(F.hex(x.bitwiseXOR(F.lit(-(2**63)).cast("long"))), 16, "0")


def _double_digits(x: Column) -> Column:
    """Sign class, exponent and digits of a double; -0.0 equals 0.0 and NaN is last. The digits
    are those of the shortest decimal form, which keeps the order of doubles."""

    def measured(shown: Column) -> Column:  # 12.5, 1.25E10
        body = F.substring_index(shown, "E", 1)
        power = F.when(F.contains(shown, F.lit("E")), F.substring_index(shown, "E", -1).try_cast("int")).otherwise(0)

        def joined(every: Column) -> Column:
            digits = F.ltrim(every, F.lit("0"))
            exponent = power + F.instr(body, ".") - (F.length(every) - F.length(digits))
            return F.concat(F.lpad((exponent + 500).cast("string"), 4, "0"), F.rpad(digits, 17, "0"))

        return let(F.replace(body, F.lit("."), F.lit("")), joined)

    size = F.when(x == 0, F.lit("0" * 21)).otherwise(let(F.abs(x).cast("string"), measured))
    inf = F.lit(float("inf"))
    return (
        F.when(F.isnan(x), F.rpad(F.lit("4"), 22, "0"))
        .when(x == inf, F.rpad(F.lit("3"), 22, "0"))
        .when(x == -inf, F.rpad(F.lit("0"), 22, "0"))
        .when(x < 0, F.concat(F.lit("1"), F.translate(size, "0123456789", "9876543210")))
        .otherwise(F.concat(F.lit("2"), size))
    )


def _digits(x: Column, kind: T.DataType) -> tuple[Column, bool]:
    """(text of 0-9 A-F whose order is that of ``x``, whether its length varies)."""
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return F.hex(F.encode(x, "UTF-8")), True
    if isinstance(kind, T.BinaryType):
        return F.hex(x), True
    if isinstance(kind, T.BooleanType):
        return x.cast("int").cast("string"), False
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return _long_digits(x.cast("long")), False
    if isinstance(kind, T.DateType):
        return _long_digits(F.unix_date(x).cast("long")), False
    if isinstance(kind, T.TimestampType):
        return _long_digits(F.unix_micros(x)), False
    if isinstance(kind, T.TimestampNTZType):
        return _long_digits(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), x)), False
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _double_digits(x.cast("double")), False
    if isinstance(kind, T.DecimalType):
        size = F.lpad(F.replace(F.abs(x).cast("string"), F.lit("."), F.lit("")), kind.precision + 1, "0")
        return F.when(x < 0, F.concat(F.lit("0"), F.translate(size, "0123456789", "9876543210"))).otherwise(F.concat(F.lit("1"), size)), False
    raise TypeError(f"no order key for {kind.simpleString()}")


def order_key(df: DataFrame, order_by: Sequence[Key | Column | str]) -> Column:
    """One text whose byte order is the order of the columns, NULLs and direction included."""
    parts = []
    for k in keys_of(order_by):
        kind = df.select(k.expr.alias("k")).schema["k"].dataType
        if isinstance(kind, T.StringType) and not (k.raw or k.desc):
            # the text itself, with an end that is before every longer text that begins alike
            text = F.concat(F.replace(k.expr, F.lit("\0"), F.lit("\0\1")), F.lit("\0\0"))
        else:
            text, varies = (k.expr, False) if k.raw else _digits(k.expr, kind)
            if k.desc:
                text = F.translate(text, _HEX, _XEH)
            if varies:
                text = F.concat(text, F.lit("~" if k.desc else "!"))
        first = (not k.desc) if k.nulls_first is None else k.nulls_first
        parts.append(F.coalesce(F.concat(F.lit("1"), text), F.lit("0" if first else "2")))
    return F.concat(*parts)


def first_bound(df: DataFrame, order_by: Sequence[Key | Column | str], key: str, upto: bool) -> Column:
    """What the first order column says about keys up to (else: from) ``key``, as a comparison
    that a scan can use to skip row groups; true where its type has no such form."""
    k = keys_of(order_by)[0]
    kind = df.select(k.expr.alias("k")).schema["k"].dataType
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if k.raw or key[0] != "1" or not (whole or isinstance(kind, (T.DateType, T.TimestampNTZType))):
        return F.lit(True)
    digits = key[1:17].translate(str.maketrans(_HEX, _XEH)) if k.desc else key[1:17]
    number = (int(digits, 16) ^ 1 << 63) - (1 << 64 if int(digits, 16) < 1 << 63 else 0)
    try:
        if whole:
            value = F.lit(number)
        elif isinstance(kind, T.DateType):
            value = F.lit((datetime(1970, 1, 1) + timedelta(days=number)).date())
        else:
            value = F.lit((datetime(1970, 1, 1) + timedelta(microseconds=number)).isoformat(sep=" ")).cast("timestamp_ntz")
    except OverflowError:  # beyond Python's calendar
        return F.lit(True)
    nulls_first = (not k.desc) if k.nulls_first is None else k.nulls_first
    side = k.expr <= value if upto != k.desc else k.expr >= value
    return side | k.expr.isNull() if upto == nulls_first else side


def row_digest(df: DataFrame) -> Column:
    """SHA-256 over all columns: rows that agree in it are equal in every column."""
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
    return F.upper(F.sha2(F.to_json(F.struct(*[df[c] for c in df.columns]), exact).cast("binary"), 256))


@dataclass(frozen=True)
class Kth:
    key: str | None
    below: int  # rows before the key
    ties: int  # rows of the key


def _shared(a: str, b: str) -> int:
    n = 0
    while n < len(a) and n < len(b) and a[n] == b[n]:
        n += 1
    return n


def kths(keys: DataFrame, wanted: Sequence[int | Callable[[int], int]]) -> dict[int, Kth]:
    """The ``k``-th (1-based) value of the one text column of ``keys`` for each k wanted (a
    number, or a function of the row count); beyond the last row there is no key, and
    ``below`` is the number of rows. A k below 1 is left out."""
    c = F.col(keys.columns[0])
    out: dict[int, Kth] = {}
    todo = [("", 0, list(wanted))]
    while todo:
        prefix, below, ks = todo.pop()
        left = keep_where(keys, c.startswith(F.lit(prefix)))  # a step of its own: the key is made once a row
        ends = left.agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("n")).first()
        lo, hi, n = ends["lo"], ends["hi"], ends["n"]
        ks = sorted({k for k in (w(n) if callable(w) else w for w in ks) if k > 0})
        out |= {k: Kth(None, below + n, 0) for k in ks if k > below + n}
        ks = [k for k in ks if k <= below + n]
        if not ks:
            continue
        if lo == hi:
            out |= {k: Kth(lo, below, n) for k in ks}
            continue
        if n <= SMALL:
            upto = F.sum("count").over(Window.orderBy(c).rowsBetween(Window.unboundedPreceding, 0)) + below
            ranked = left.groupBy(c).count().withColumn("upto", upto)
            hit = F.lit(False)
            for k in ks:
                hit = hit | ((F.col("upto") >= k) & (F.col("upto") - F.col("count") < k))
            for key, same, end in keep_where(ranked, hit).collect():  # a row per k at most
                out |= {k: Kth(key, end - same, same) for k in ks if end - same < k <= end}
            continue
        at = _shared(lo, hi)
        widths = left.agg(*[F.approx_count_distinct(F.substring(c, at + 1, w)).alias(f"w{w}") for w in WIDTHS]).first()
        width = max([w for w in WIDTHS if widths[f"w{w}"] <= RANGES], default=1)
        counts = left.groupBy(F.substring(c, at + 1, width).alias("p")).count().collect()
        for part, size in sorted((r["p"], r["count"]) for r in counts):
            inside = [k for k in ks if below < k <= below + size]
            if inside:
                todo.append((lo[:at] + part, below, inside))
            below += size
    return out


def kth(keys: DataFrame, k: int) -> Kth:
    return kths(keys, [k])[k]


def _native(k: Key, kind: T.DataType) -> Column:
    """An order column as Spark compares it and as Python can hold it exactly."""
    if isinstance(kind, T.DateType):
        return F.unix_date(k.expr).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(k.expr)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), k.expr)
    return k.expr


def _sorts(k: Key) -> Column:
    first = (not k.desc) if k.nulls_first is None else k.nulls_first
    if k.desc:
        return k.expr.desc_nulls_first() if first else k.expr.desc_nulls_last()
    return k.expr.asc_nulls_first() if first else k.expr.asc_nulls_last()


@dataclass(frozen=True)
class Span:
    """Neighbouring rows of an order: ``before`` tells the rows ahead of it, ``inside`` its own;
    both are never null. ``found``: the k-th rows that lie in it."""

    before: Column
    inside: Column
    found: dict[int, Kth]


def located(df: DataFrame, order_by: Sequence[Key | Column | str], wanted: Sequence[int | Callable[[int], int]]) -> list[Span]:
    """``kths`` of the order's keys, and for each the span of rows to which the text need be made."""
    keys = keys_of(order_by)
    kinds = [df.select(k.expr.alias("k")).schema["k"].dataType for k in keys]
    key = order_key(df, order_by)
    no, yes = F.lit(False), F.lit(True)

    def span(before: Column, inside: Column, skipped: int, ks: Sequence) -> Span:
        found = kths(df.filter(inside).select(key.alias("k")), [k if callable(k) else k - skipped for k in ks])
        return Span(before, inside, {k + skipped: Kth(f.key, f.below + skipped, f.ties) for k, f in found.items()})

    n = df.count()
    ks = sorted({k for k in (w(n) if callable(w) else w for w in wanted) if k > 0})
    spans = [Span(no, yes, {k: Kth(None, n, 0)}) for k in ks if k > n]
    todo = [(0, no, yes, 0, n, [k for k in ks if k <= n])]
    while todo:
        j, before, inside, skipped, n, ks = todo.pop()
        if not ks:
            continue
        if n <= SMALL or j == len(keys):
            spans.append(span(before, inside, skipped, ks))
            continue
        k, x = keys[j], _native(keys[j], kinds[j])
        nulls_first = (not k.desc) if k.nulls_first is None else k.nulls_first
        rows = df.filter(inside).select(x.alias("x"))

        def ahead(v, x=x, k=k, nulls_first=nulls_first) -> Column:
            if v is None:
                return no if nulls_first else x.isNotNull()
            return F.coalesce(x > F.lit(v) if k.desc else x < F.lit(v), F.lit(nulls_first))

        if rows.agg(F.approx_count_distinct("x")).first()[0] <= VALUES:
            at, order = skipped, _sorts(Key("x", k.desc, k.nulls_first))
            for v, size in rows.groupBy("x").count().orderBy(order).collect():
                here = [q for q in ks if at < q <= at + size]
                if here:
                    same = x.isNull() if v is None else F.coalesce(x == F.lit(v), no)
                    todo.append((j + 1, before | (inside & ahead(v)), inside & same, at, size, here))
                at += size
            continue
        numbers = F.when(~F.isnan("x"), F.col("x")) if isinstance(kinds[j], (T.FloatType, T.DoubleType)) else F.col("x")
        if not isinstance(kinds[j], (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            spans.append(span(before, inside, skipped, ks))
            continue
        nan = F.isnan("x") if isinstance(kinds[j], (T.FloatType, T.DoubleType)) else no
        head = rows.agg(F.count_if(F.col("x").isNull()).alias("nulls"), F.count_if(nan).alias("nans"), F.count(numbers).alias("n")).first()
        groups = [("number", head["n"]), (float("nan"), head["nans"])]
        groups = groups[::-1] if k.desc else groups
        groups = [(None, head["nulls"]), *groups] if nulls_first else [*groups, (None, head["nulls"])]
        at, asked = skipped, []
        for v, size in groups:
            here = [q for q in ks if at < q <= at + size]
            if v == "number":
                asked = [(q, (q - at) / size) for q in here]
            elif here:
                same = x.isNull() if v is None else F.coalesce(x == F.lit(v), no)
                todo.append((j + 1, before | (inside & ahead(v)), inside & same, at, size, here))
            at += size
        for q, rank in asked:
            rank = 1 - rank if k.desc else rank
            share = [min(max(rank + m, 0.0), 1.0) for m in (-MARGIN, MARGIN)]
            lo, hi = rows.agg(F.percentile_approx(numbers, share, 10_000)).first()[0]
            first, last = (hi, lo) if k.desc else (lo, hi)
            between = F.coalesce((x >= F.lit(lo)) & (x <= F.lit(hi)), no)
            sizes = df.filter(inside).agg(F.count_if(ahead(first)).alias("ahead"), F.count_if(between).alias("here")).first()
            at = skipped + sizes["ahead"]
            if at < q <= at + sizes["here"]:
                spans.append(span(before | (inside & ahead(first)), inside & between, at, [q]))
            else:  # the quantile was off
                spans.append(span(before, inside, skipped, [q]))
    return spans


class Cut:
    """The first ``k`` rows of ``df`` in an order (all of them if ``k`` is beyond the last;
    ``k`` may be a function of the row count): ``inside()``, ``marked()``."""

    def __init__(self, df: DataFrame, order_by: Sequence[Key | Column | str], k: int | Callable[[int], int], within: Span | None = None):
        self.df = df
        key = order_key(df, order_by)
        self.copies = self.rest = 0  # of rows equal in every column: how many are inside, how many are not
        self.same, self.bound = F.lit(False), F.lit(True)
        made = [within] if within else located(df, order_by, [k])
        if not made:  # no row is inside
            self.cond = F.lit(False)
            return
        within = made[0]
        k, found = max(within.found.items()) if callable(k) else (k, within.found[k])
        self.k = k
        if found.key is None:
            self.cond = F.lit(True)
            return
        self.bound = first_bound(df, order_by, found.key, True)
        if found.below + found.ties == self.k:
            self.cond = within.before | (within.inside & (key <= F.lit(found.key)))
            return
        tie = within.inside & (key == F.lit(found.key))
        less = within.before | (within.inside & (key < F.lit(found.key)))
        digest = row_digest(df)
        split = kth(df.filter(tie).select(digest.alias("k")), self.k - found.below)
        self.cond = less | (tie & (digest <= F.lit(split.key)))
        self.copies = self.k - found.below - split.below
        self.rest = split.ties - self.copies
        if self.rest:  # the k-th row lies among rows equal in every column
            self.same = tie & (digest == F.lit(split.key))
            self.cond = less | (tie & (digest < F.lit(split.key)))

    def _equal(self, n: int) -> DataFrame:
        """``n`` of the equal rows."""
        one = self.df.filter(self.bound & self.same).limit(1)
        blocks = F.explode(F.sequence(F.lit(0), F.lit((n - 1) // 10_000))).alias("_cc_b")
        each = F.explode(F.sequence(F.lit(1), F.least(F.lit(10_000).cast("long"), F.lit(n) - F.col("_cc_b") * 10_000))).alias("_cc_i")
        return one.select("*", blocks).select("*", each).drop("_cc_b", "_cc_i")

    def inside(self) -> DataFrame:
        out = self.df.filter(self.bound & self.cond)
        return out.unionByName(self._equal(self.copies)) if self.rest else out

    def marked(self, col: str, inside: str, outside: str) -> DataFrame:
        mark = F.when(self.cond, F.lit(inside)).otherwise(F.lit(outside))
        if not self.rest:
            return self.df.withColumn(col, mark)
        out = self.df.filter(~self.same).withColumn(col, mark)
        for n, name in ((self.copies, inside), (self.rest, outside)):
            out = out.unionByName(self._equal(n).withColumn(col, F.lit(name)))
        return out


def page(df: DataFrame, order_by: Sequence[Key | Column | str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit - 1``, in order, at any depth: two cuts find the
    page's keys, and only the page is sorted. The order is that of the keys; rows that share
    one are ordered by a digest of their columns."""
    offset, limit = max(int(offset or 0), 0), max(int(limit), 0)
    if not limit:
        return df.limit(0)
    if offset + limit <= SHALLOW:
        order_key(df, order_by)  # refuses what has no order
        return df.orderBy(*map(_sorts, keys_of(order_by)), row_digest(df)).limit(offset + limit).offset(offset)
    found = {k: s for s in located(df, order_by, [offset + 1, offset + limit] if offset else [limit]) for k in s.found}
    first = found[offset + 1].found[offset + 1] if offset else None
    if first and first.key is None:
        return df.limit(0)
    rows = Cut(df, order_by, offset + limit, found[offset + limit]).inside()
    order = [order_key(rows, order_by), row_digest(rows)]
    if not first:
        return rows.orderBy(*order).limit(limit)
    rows = rows.filter(first_bound(df, order_by, first.key, False))
    # rows of the first key that belong to earlier pages
    skip = offset - first.below
    here = rows.filter(order_key(rows, order_by) >= F.lit(first.key))
    if skip == 0:
        return here.orderBy(*order).limit(limit)
    split = kth(here.filter(order_key(rows, order_by) == F.lit(first.key)).select(row_digest(rows).alias("k")), skip + 1)
    at = order_key(here, order_by) == F.lit(first.key)
    digest = row_digest(here)
    after = here.filter(~at | (digest > F.lit(split.key)))
    left = split.below + split.ties - skip  # rows equal to the page's first one
    equal = here.filter(at & (digest == F.lit(split.key))).limit(min(left, limit))
    return after.unionByName(equal).orderBy(order_key(df, order_by), row_digest(df)).limit(limit)


def positions(df: DataFrame, order_by: Sequence[Key | Column | str], index_col: str, total_col: str | None = None) -> DataFrame:
    """``df`` (the columns that name a row, nothing wide) with the 0-based position of every
    row, and the row count. Keys are cut into ranges of at most ``RANGE_ROWS`` rows by counting
    (rows of one key stay together, so keys should be unique); a range's position is the count
    before it, and only a range is ranked by one task."""
    keyed = df.withColumn("_cc_key", order_key(df, order_by)).withColumn("_cc_range", F.lit(""))
    spark = df.sparkSession
    ends = keyed.agg(F.min("_cc_key").alias("lo"), F.max("_cc_key").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    sizes = {"": ends["n"]}
    open_ = [("", ends["lo"], ends["hi"])] if ends["n"] > RANGE_ROWS else []
    while open_:
        # a range that is too large takes the characters after what its keys share
        step = spark.createDataFrame([(r, _shared(lo, hi) + WIDTH) for r, lo, hi in open_], "_cc_range string, _cc_len int")
        keyed = keyed.join(F.broadcast(step), "_cc_range", "left").withColumn(
            "_cc_range", F.when(F.col("_cc_len").isNull(), F.col("_cc_range")).otherwise(F.expr("substring(_cc_key, 1, _cc_len)"))
        ).drop("_cc_len")
        for r, *_ in open_:
            del sizes[r]
        inner = keyed.join(F.broadcast(spark.createDataFrame([(r,) for r in sizes], "_cc_range string")), "_cc_range", "left_anti") if sizes else keyed
        found = {r["_cc_range"]: r["count"] for r in inner.groupBy("_cc_range").count().collect()}
        sizes |= found
        big = [r for r, n in found.items() if n > RANGE_ROWS]
        open_ = []
        if big:
            wide = keyed.join(F.broadcast(spark.createDataFrame([(r,) for r in big], "_cc_range string")), "_cc_range", "left_semi")
            spans = wide.groupBy("_cc_range").agg(F.min("_cc_key").alias("lo"), F.max("_cc_key").alias("hi")).collect()
            open_ = [tuple(s) for s in spans if s["lo"] != s["hi"]]
    starts, before = [], 0
    for r in sorted(sizes):
        starts.append((r, before))
        before += sizes[r]
    offsets = spark.createDataFrame(starts, "_cc_range string, _cc_start long")
    nth = F.row_number().over(Window.partitionBy("_cc_range").orderBy("_cc_key")) - 1
    out = keyed.withColumn("_cc_nth", nth).join(F.broadcast(offsets), "_cc_range").withColumn(index_col, F.col("_cc_start") + F.col("_cc_nth"))
    if total_col:
        out = out.withColumn(total_col, F.lit(ends["n"]).cast("long"))
    return out.drop("_cc_key", "_cc_range", "_cc_start", "_cc_nth")
