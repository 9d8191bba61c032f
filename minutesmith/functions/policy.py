"""Collection policy as predicates and windows: opening hours, notices, throttling, retries. Nothing here fetches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RETRIED = (408, 429, 500, 502, 503, 504)


@dataclass(frozen=True)
class FetchWindow:
    """Hours in which fetching is allowed, in local time. days counts from Monday 0; end 0 is the end of the day; a window that
    wraps past midnight belongs to the day it opened on."""

    days: tuple[int, ...]
    start: int  # minutes of the day
    end: int
    zone: str = "Asia/Tokyo"

    def __post_init__(self) -> None:
        if not self.days or not all(0 <= d <= 6 for d in self.days) or not 0 <= self.start < 1440 or not 0 <= self.end < 1440:
            raise ValueError(f"no such window: {self}")

    def allows(self, ts: Column) -> Column:
        local = F.from_utc_timestamp(ts, self.zone)
        minute, day = F.hour(local) * 60 + F.minute(local), F.weekday(local)
        end = self.end or 1440
        today = day.isin(*self.days)
        if self.start < end:
            return today & (minute >= self.start) & (minute < end)
        yesterday = F.pmod(day + 6, F.lit(7)).isin(*self.days)
        return (today & (minute >= self.start)) | (yesterday & (minute < end))

    def next_open(self, df: DataFrame, ts: str, horizon: int = 370) -> DataFrame:
        """df with opens_on: the first local day on which the window opens at or after ts; NULL if none within the horizon."""
        local = F.to_date(F.from_utc_timestamp(F.col(ts), self.zone))
        days = F.filter(F.transform(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda i: F.date_add(local, i)), lambda d: F.weekday(d).isin(*self.days))
        return df.withColumn("opens_on", F.get(days, F.lit(0)))


def throttled(df: DataFrame, host: str, order: list[str], arrival: str, interval: Column, name: str = "start_at") -> DataFrame:
    """df with the second at which each request may start: at its arrival, and one interval after the one before on its host.

    Closed form: i * interval + the running maximum of arrival - i * interval."""
    w = Window.partitionBy(host).orderBy(*order)
    i = F.row_number().over(w) - 1
    slack = df.withColumn("_i", i).withColumn("_slack", F.col(arrival) - F.col("_i") * interval)
    top = F.max("_slack").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return slack.withColumn(name, F.col("_i") * interval + top).drop("_i", "_slack")


def retry_action(status: Column, attempt: Column, attempts: int = 3) -> Column:
    """'ok', 'retry' or 'fail' of an answer."""
    return F.when(status < 400, "ok").when(status.isin(*RETRIED) & (attempt < attempts), "retry").otherwise("fail")


def backoff_seconds(attempt: Column) -> Column:
    return F.least(F.pow(F.lit(2.0), attempt), F.lit(60.0))


def covered(day: Column, first: Column, last: Column, sent: Column) -> Column:
    """Whether a notice covers a day: only one that was sent does, and its range is inclusive."""
    return F.coalesce(sent & (day >= first) & (day <= last), F.lit(False))


def exempt(url: Column, prefixes: Column) -> Column:
    """Whether an address lies under any of an array of prefixes."""
    return F.coalesce(F.exists(prefixes, lambda p: F.startswith(url, p)), F.lit(False))


def interval_seconds(own: Column, crawl_delay: Column) -> Column:
    """Seconds between requests to a host: the longer of one's own interval and what its robots file asks for."""
    return F.greatest(own.cast("double"), F.coalesce(crawl_delay.cast("double"), F.lit(0.0)))


def retry_wait(attempt: Column, retry_after: Column) -> Column:
    """Seconds before a request is sent again: what the answer asks for, else the backoff; what is no number asks for nothing."""
    return F.coalesce(retry_after.try_cast("double"), backoff_seconds(attempt))
