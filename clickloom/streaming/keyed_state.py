"""Keyed state of the ad streams: what is remembered of users, and of each province's ads.

Each processor sees the rows of one key and one micro-batch as an iterator. With an
allowed lateness, timers take days out of the state that no row can belong to any more.
Rows and state are kept narrow, since they cross to Python and back.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# A click as one text: each column of a row costs as much in Python as reading a whole text.
CLICK = ["ts_us", "date", "day_end_ms", "user_id", "ad_id", "value"]
OUTCOME = (
    "clicks array<string>, late array<string>, dates array<string>, user_ids array<bigint>, "
    "ad_ids array<bigint>, click_counts array<bigint>, listed array<bigint>"
)
# So many lines or totals are given out in one row.
PER_ROW = 1000
TOP_ADS = (
    "date string, province string, slot long, version long, "
    "ad_ids array<bigint>, click_counts array<bigint>"
)


class ClickFilter(StatefulProcessor):
    """Filter, count and list the users of clicks, keyed by bucket of users.

    Gives out, as lists, the lines of accepted clicks (``clicks``) and of clicks behind the
    watermark (``late``), the new totals by day, user and ad, and the users of whom some total
    has reached the threshold (``listed``). A listed user's clicks are dropped from the next
    micro-batch on.

    A key, a call to the state and a row given out each cost as much as reading many clicks.
    So users share buckets, a bucket's totals of one day are one entry, and a row holds many lines.
    """

    def __init__(self, threshold: int, expires: bool):
        self.threshold, self.expires = threshold, expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.listed = handle.getValueState("listed", "user_ids array<bigint>")
        self.counts = handle.getMapState(
            "counts",
            "date string",
            "day_end_ms long, user_ids array<bigint>, ad_ids array<bigint>, ns array<bigint>",
        )

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.listed.get()
        listed = set() if before is None else set(before[0])
        bound_us = 1000 * timerValues.getCurrentWatermarkInMs() if self.expires else None
        clicks, late, seen, day_ends = [], [], {}, {}
        for _, click in rows:
            ts_us, date, day_end_ms, user, ad, value = click.split(" ", 5)
            user_id = int(user)
            if user_id in listed:
                continue
            if bound_us is not None and int(ts_us) < bound_us:
                late.append(value)
            else:
                clicks.append(value)
                if date not in seen:
                    seen[date], day_ends[date] = Counter(), int(day_end_ms)
                seen[date][user_id, int(ad)] += 1
            if len(clicks) + len(late) == PER_ROW:
                yield _outcome(clicks, late)
                clicks, late = [], []
        days, totals = {}, []
        for date, found in seen.items():
            day = days[date] = _totals(self.counts.getValue((date,)))
            for pair, n in found.items():
                day[pair] = n + day.get(pair, 0)
                totals.append((date, *pair, day[pair]))
        reached = {user_id for _, user_id, _, n in totals if n >= self.threshold}
        if reached:
            # Nothing more is counted of a listed user.
            self.listed.update(([*listed, *reached],))
            self._forget(reached, days)
        for date, day in days.items():
            kept = {pair: n for pair, n in day.items() if pair[0] not in reached}
            self._keep(date, day_ends[date], kept)
            if kept and self.expires:
                self.handle.registerTimer(day_ends[date])
        if clicks or late or totals:
            yield _outcome(clicks, late, totals[:PER_ROW], reached)
        for i in range(PER_ROW, len(totals), PER_ROW):
            yield _outcome(totals=totals[i : i + PER_ROW])

    def _forget(self, users: set[int], days: dict) -> None:
        """Take users out of the totals of other days than ``days``."""
        for (date,), stored in list(self.counts.iterator()):
            if date not in days and not users.isdisjoint(stored[1]):
                kept = {pair: n for pair, n in _totals(stored).items() if pair[0] not in users}
                self._keep(date, stored[0], kept)

    def _keep(self, date: str, day_end_ms: int, totals: dict) -> None:
        if totals:
            users, ads = zip(*totals)
            self.counts.updateValue((date,), (day_end_ms, [*users], [*ads], [*totals.values()]))
        else:
            self.counts.removeKey((date,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.counts.exists():
            _drop_days(self.counts, expiredTimerInfo.getExpiryTimeInMs(), 0)
        return iter(())

    def close(self) -> None:
        pass


class TopAds(StatefulProcessor):
    """The ``k`` most clicked ads, keyed by (date, province, slot of ads).

    An ad has one slot, so the top of a province is among the tops of its slots, and a
    province with very many clicks is spread over tasks. A top is given out when it has
    changed, with the slot's clicks so far as a version that only grows.
    """

    def __init__(self, k: int, expires: bool):
        self.k, self.expires = k, expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "ad_id long", "n long")
        self.best = handle.getValueState("best", "version long, ad_ids array<bigint>, click_counts array<bigint>")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        day_end_ms = None
        seen = Counter()
        for row in rows:
            seen[row["ad_id"]] += 1
            day_end_ms = row["day_end_ms"]
        known = self.best.get() if self.best.exists() else (0, [], [])
        before = list(zip(known[1], known[2]))
        # Counts only grow: a new top is made of the old one and of what was clicked now.
        counts = dict(before)
        for ad_id, n in seen.items():
            total = self.counts.getValue((ad_id,))
            counts[ad_id] = n if total is None else n + total[0]
            self.counts.updateValue((ad_id,), (counts[ad_id],))
        top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: self.k]
        version = known[0] + seen.total()
        ad_ids, click_counts = [a for a, _ in top], [n for _, n in top]
        self.best.update((version, ad_ids, click_counts))
        if self.expires:
            self.handle.registerTimer(day_end_ms)
        if top != before:
            date, province, slot = key
            yield Row(
                date=date, province=province, slot=slot, version=version, ad_ids=ad_ids,
                click_counts=click_counts,
            )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # The key is a day, so all of it goes.
        self.counts.clear()
        self.best.clear()
        return iter(())

    def close(self) -> None:
        pass


def _outcome(clicks=(), late=(), totals=(), listed=()) -> Row:
    dates, user_ids, ad_ids, counts = zip(*totals) if totals else ((),) * 4
    return Row(
        clicks=[*clicks], late=[*late], dates=[*dates], user_ids=[*user_ids], ad_ids=[*ad_ids],
        click_counts=[*counts], listed=[*listed],
    )


def _totals(day) -> dict[tuple[int, int], int]:
    """A day's entry as totals by (user, ad)."""
    return {} if day is None else dict(zip(zip(day[1], day[2]), day[3]))


def _drop_days(counts, until_ms: int, place: int) -> None:
    """Remove the entries of a map state whose day ended by ``until_ms``."""
    for key in [k for k, v in counts.iterator() if v[place] <= until_ms]:
        counts.removeKey(key)
