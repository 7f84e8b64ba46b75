"""Articles and daily bars as one stream: each article comes out once, with its bars, when its weeks have passed.

Both streams are put together by range of ``1 << SHIFT`` tickers and block of ``PAGES`` calendar pages of ``days`` days: an
article needs the bars of its own block and of the first page after it. Before they are shuffled, articles and bars of a range,
block and day are packed into one row of fixed records, so that neither Spark nor Python handles them one by one; a day's rows
keep their event time. A processor keeps the articles that wait and the bars as two lists of such records, which take one call
each for all rows of a batch, and frees both by event-time timers, one for the next article that is due and one for the end of
the block. The articles of a range and block are spread over ``salts`` keys, each with its own copy of the bars, so that a
ticker with most of the articles is no single task.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import BinaryType, BooleanType, IntegerType, LongType, Row, StructField, StructType

from newslens import fixed_values as fv

PAGES = 13  # in a block: a year of four weeks
SHIFT = 9  # of a ticker's number to that of its range
_DAY = 86_400_000
_HELD = 1 << 19  # rows that are packed together
_SENT = 1 << 16  # articles in one row of results
_ARTICLE = np.dtype([("ticker", "<i8"), ("id", "<i8"), ("day", "<i4")])
_BAR = np.dtype([("ticker", "<i8"), ("day", "<i4"), ("known", "u1"), ("price", "<f8", 4)])  # known: a bit for each price
_EPOCH = date(1970, 1, 1)
BAR = "date date, open double, high double, low double, close double"
FIELDS = ("date", "open", "high", "low", "close")
PRICED = "id long, ticker long, published date, prices array<struct<date:date,open:double,high:double,low:double,close:double>>"
_FOUND = "ticker boolean, dated boolean, articles binary, bars binary, number binary"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _millis(day) -> int:
    return int(datetime(day.year, day.month, day.day, tzinfo=timezone.utc).timestamp() * 1000)


class Windows(StatefulProcessor):
    """Waiting articles, the bars of their block, and timers for the next window that ends and for the end of the block."""

    def __init__(self, days: int):
        self.days = days

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "id long, published date")
        self.bars = handle.getListState("bars", BAR)

    def _due(self, published) -> int:
        return _millis(published + timedelta(days=self.days + 1))

    def _end(self, key) -> int:
        """When no article of the block is due later."""
        return _millis(datetime(1970, 1, 1) + timedelta(days=(key[1] + 1) * PAGES * self.days + self.days + 1))

    def handleInputRows(self, key, rows, timerValues):
        articles, bars = [], []
        for row in rows:
            if row.id is None:
                bars.append(tuple(row[f] for f in FIELDS))
            else:
                articles.append((row.id, row.published))
        if articles:
            self.waiting.appendList(articles)
            self.handle.registerTimer(min(self._due(published) for _, published in articles))
        if bars:
            self.bars.appendList(bars)
            self.handle.registerTimer(self._end(key))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = expiredTimerInfo.getExpiryTimeInMs()
        passed = max(now, timerValues.getCurrentWatermarkInMs())
        # an article that comes again replaces itself on its page
        last = {(id_, (published - _EPOCH).days // self.days): published for id_, published in self.waiting.get()}
        waiting = [(id_, published) for (id_, _), published in last.items()]
        due = [a for a in waiting if self._due(a[1]) <= passed]
        if due:
            later = [a for a in waiting if self._due(a[1]) > passed]
            if later:
                self.waiting.put(later)
                self.handle.registerTimer(min(self._due(published) for _, published in later))
            else:
                self.waiting.clear()
            by_day = {b[0]: tuple(b) for b in self.bars.get()}  # of two bars of a day the later one counts
            by_day.pop(None, None)
            days = sorted(by_day)
            for id_, published in due:
                until = published + timedelta(days=self.days)
                own = days[bisect_left(days, published) : bisect_right(days, until)]
                prices = [dict(zip(FIELDS, by_day[d])) for d in own]
                yield Row(id=id_, ticker=key[0], published=published, prices=prices or None)
        if now >= self._end(key):
            self.bars.clear()

    def close(self) -> None:
        pass


def _packed(rows: pa.Table, names: list[str]) -> Iterator[pa.RecordBatch]:
    """A row for all articles, and one for all bars, of one key and event time, in the order in which they came."""
    for articles in (True, False):
        some = rows.filter(pc.equal(rows.column("articles"), articles))
        if not some.num_rows:
            continue
        number = lambda c: pc.fill_null(some.column(c), 0).to_numpy()
        day, keys = some.column("day").cast(pa.int32()), []
        for c in ("ticker", "page", "salt"):
            keys += [some.column(c).is_null().to_numpy(), number(c)]
        keys.append(pc.fill_null(day, 0).to_numpy())
        order = np.lexsort(keys[::-1])
        record = np.zeros(len(order), _ARTICLE if articles else _BAR)
        record["ticker"], record["day"] = number("of"), keys[-1]
        if articles:
            record["id"] = number("id")
        else:
            for k, c in enumerate(FIELDS[1:]):
                record["price"][:, k] = number(c)
                record["known"] |= some.column(c).is_valid().to_numpy().astype(np.uint8) << np.uint8(k)
        new = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
        first = np.append(0, np.flatnonzero(new) + 1)
        ends = (np.append(first, len(order)) * record.itemsize).astype(np.int64)
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(record[order].tobytes())]
        )
        lead = some.select(names[:-1]).take(pa.array(order[first]))
        yield from lead.append_column("packed", packed.cast(pa.binary())).to_batches()


class PackedWindows(StatefulProcessor):
    """What :class:`Windows` does, for the articles and bars of many tickers as records."""

    def __init__(self, days: int):
        self.days = days

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "packed binary")
        self.bars = handle.getListState("bars", "packed binary")

    def _end(self, key) -> int:
        """When no article of the block is due later."""
        return ((key[1] + 1) * PAGES * self.days + self.days + 1) * _DAY

    def _wait(self, articles: np.ndarray) -> None:
        self.handle.registerTimer((int(articles["day"].min()) + self.days + 1) * _DAY)

    def handleInputRows(self, key, rows, timerValues):
        packed = {True: [], False: []}
        for row in rows:
            packed[row.articles].append(bytes(row.packed))
        articles, bars = (b"".join(packed[kind]) for kind in (True, False))
        if key[1] is None:  # without a day there are no prices to wait for
            return self._rows(key, np.frombuffer(articles, _ARTICLE), np.zeros(0, _BAR))
        if articles:
            self.waiting.appendList([(articles,)])
            self._wait(np.frombuffer(articles, _ARTICLE))
        if bars:
            self.bars.appendList([(bars,)])
            self.handle.registerTimer(self._end(key))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = expiredTimerInfo.getExpiryTimeInMs()
        passed = max(now, timerValues.getCurrentWatermarkInMs())
        waiting = np.frombuffer(b"".join(bytes(x[0]) for x in self.waiting.get()), _ARTICLE)
        # an article that comes again replaces itself on its page
        waiting = _last(waiting, waiting["day"] // self.days, waiting["id"], waiting["ticker"])
        is_due = (waiting["day"].astype(np.int64) + self.days + 1) * _DAY <= passed
        if is_due.any():
            later = waiting[~is_due]
            if len(later):
                self.waiting.put([(later.tobytes(),)])
                self._wait(later)
            else:
                self.waiting.clear()
            bars = np.frombuffer(b"".join(bytes(x[0]) for x in self.bars.get()), _BAR)
            yield from self._rows(key, waiting[is_due], _last(bars, bars["day"], bars["ticker"]))  # of two bars of a day the later one counts
        if now >= self._end(key):
            self.bars.clear()

    def _rows(self, key, due: np.ndarray, bars: np.ndarray) -> Iterator[Row]:
        base = 0 if key[0] is None else key[0] << SHIFT
        at = lambda ticker, day: ((ticker - base) << 32) + day.astype(np.int64) + (1 << 31)
        days = at(bars["ticker"], bars["day"])
        for k in range(0, len(due), _SENT):
            some = due[k : k + _SENT]
            first = np.searchsorted(days, at(some["ticker"], some["day"]))
            number = np.searchsorted(days, at(some["ticker"], some["day"].astype(np.int64) + self.days), "right") - first
            place = np.repeat(first - np.cumsum(number) + number, number) + np.arange(number.sum())
            number = number.astype(np.int32).tobytes()
            yield Row(ticker=key[0] is not None, dated=key[1] is not None, articles=some.tobytes(), bars=bars[place].tobytes(), number=number)

    def close(self) -> None:
        pass


def _last(records: np.ndarray, *by: np.ndarray) -> np.ndarray:
    """The last record of those alike, sorted by the last key first."""
    order = np.lexsort(by)
    differ = np.any([k[order][1:] != k[order][:-1] for k in by], axis=0)
    return records[order][np.append(differ, True)] if len(records) else records


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            articles, bars = np.frombuffer(row["articles"], _ARTICLE), np.frombuffer(row["bars"], _BAR)
            number = np.frombuffer(row["number"], np.int32)
            dates = lambda days: pa.array(np.ascontiguousarray(days)).cast(pa.date32())
            prices = [pa.array(bars["price"][:, k], mask=bars["known"] >> k & 1 == 0) for k in range(4)]
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(number)).astype(np.int32)),
                pa.StructArray.from_arrays([dates(bars["day"]), *prices], names=list(FIELDS)),
                mask=pa.array(number == 0),
            )
            none = np.full(len(articles), not row["ticker"])
            known = row["dated"]
            columns = [
                pa.array(np.ascontiguousarray(articles["id"])),
                pa.array(np.ascontiguousarray(articles["ticker"]), mask=none),
                dates(articles["day"]) if known else pa.nulls(len(articles), pa.date32()),
                lists,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "ticker", "published", "prices"])


def attach_by_timers(
    articles: DataFrame,
    bars: DataFrame,
    days: int = fv.PRICE_WINDOW_DAYS,
    delay: str = "1 day",
    salts: int = 8,
) -> DataFrame:
    """``articles(id, ticker, published)`` and ``bars(ticker, date, open, high, low, close)``, both streams, to one
    row per article with ``prices``, its bars from publication to ``days`` days later by date; NULL without any.

    An article comes out when the watermark, ``delay`` behind the latest day seen, has passed its window. Rows that
    are later than the watermark are dropped. Ids are unique; of two bars of a day the later one counts.
    """
    page = lambda day: F.floor(F.unix_date(day) / (PAGES * days))
    none, of = F.lit(None), F.col("ticker").cast("long")
    waiting = articles.where("id is not null").select(
        F.shiftright(of, SHIFT).alias("ticker"),
        page(F.col("published")).alias("page"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"),
        F.col("published").cast("timestamp").alias("at"),
        F.lit(True).alias("articles"),
        F.col("id").cast("long").alias("id"),
        of.alias("of"),
        F.col("published").alias("day"),
        *[none.cast("double").alias(f) for f in FIELDS[1:]],
    )
    copied = bars.where("date is not null").select(
        F.shiftright(of, SHIFT).alias("ticker"),
        F.explode(F.array_distinct(F.array(page(F.col("date")), page(F.date_sub("date", days))))).alias("page"),
        F.col("date").cast("timestamp").alias("at"),
        F.lit(False).alias("articles"),
        none.cast("long").alias("id"),
        of.alias("of"),
        F.col("date").alias("day"),
        *FIELDS[1:],
    ).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = waiting.unionByName(copied).withWatermark("at", delay)
    kinds = {"ticker": LongType(), "page": LongType(), "salt": IntegerType(), "articles": BooleanType(), "packed": BinaryType()}
    fields = [StructField(c, kind) for c, kind in kinds.items()]
    fields.insert(3, both.schema["at"])  # which says that it is the event time
    names = [f.name for f in fields]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= _HELD:
                yield from _packed(pa.Table.from_batches(held), names)
                held = []
        if held:
            yield from _packed(pa.Table.from_batches(held), names)

    rows = both.mapInArrow(pack, StructType(fields))
    found = rows.groupBy("ticker", "page", "salt").transformWithState(PackedWindows(days), _FOUND, "Append", "EventTime")
    return found.mapInArrow(_unpacked, PRICED)


def run_with_timers(priced: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process all available input into a Parquet table and return it. Timers need the RocksDB state store."""
    spark: SparkSession = priced.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        query = (
            priced.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)
    return spark.read.schema(priced.schema).parquet(path)
