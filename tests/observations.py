"""A small archive of our own making: three boats, eight files, every way in which a reading can be delivered again."""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from pathlib import Path

from fathomline.functions.schema import PUBLISHED, struct


@dataclass(frozen=True)
class Reading:
    time: str
    lon: str
    lat: str
    depth: str


# The sound, surveyed by heron and otter.
A1 = Reading("2025-03-01T06:00:00Z", "10.31", "55.402", "7.2")
A2 = Reading("2025-03-01T06:00:20Z", "10.34", "55.411", "7.9")
A3 = Reading("2025-03-01T06:00:40Z", "10.37", "55.423", "9.4")
A4 = Reading("2025-03-01T06:01:00Z", "10.40", "55.437", "12.1")
B1 = Reading("2025-03-01T06:01:30Z", "10.44", "55.450", "15.8")
B2 = Reading("2025-03-01T06:02:00Z", "10.46", "55.461", "16.3")
E1 = Reading("2025-03-01T06:03:10Z", "10.52", "55.488", "21.0")
# The strait, surveyed by tern, a month earlier and far from the sound.
C1 = Reading("2025-02-11T17:30:00Z", "12.61", "55.980", "31.0")
C2 = Reading("2025-02-11T17:30:30Z", "12.63", "55.991", "33.5")
C3 = Reading("2025-02-11T17:31:00Z", "12.66", "56.003", "30.2")
D1 = Reading("2025-02-12T09:00:00Z", "12.70", "56.020", "28.8")
D2 = Reading("2025-02-12T09:00:30Z", "12.71", "56.024", "28.1")
NONSENSE = Reading("yesterday", "over there", "-", "deep")


@dataclass(frozen=True)
class Delivery:
    stamp: str
    boat: str
    provider: str
    readings: tuple[Reading, ...]
    #: What a full census finds: rows, originals, sent again by the same boat, known from another boat.
    counts: tuple[int, int, int, int]

    @property
    def name(self) -> str:
        return f"{self.stamp}000000_{self.boat}.csv"

    @property
    def when(self) -> datetime:
        return datetime.strptime(self.stamp, "%Y%m%d%H%M%S").replace(tzinfo=UTC)


DELIVERIES = {
    "line": Delivery("20250302000500", "heron", "sound", (A1, A2, A3, A4), (4, 4, 0, 0)),
    "handover": Delivery("20250302060500", "otter", "sound", (A4, B1, B2), (3, 2, 0, 1)),
    "strait": Delivery("20250303000500", "tern", "strait", (C1, C2, C3), (3, 3, 0, 0)),
    "line again": Delivery("20250303060500", "heron", "sound", (A1, A2, A3, A4), (4, 0, 4, 0)),
    "overlap": Delivery("20250303120500", "tern", "strait", (C3, D1), (2, 1, 1, 0)),
    "mixture": Delivery("20250303180500", "otter", "sound", (B2, A2, E1), (3, 1, 1, 1)),
    "twice in one": Delivery("20250304000500", "tern", "strait", (D2, D2), (2, 1, 1, 0)),
    "strait again": Delivery("20250304000600", "tern", "strait", (C1, C2, C3), (3, 0, 3, 0)),
}
#: Rows, originals, resends and cross-boat copies of all.
WHOLE = tuple(map(sum, zip(*(d.counts for d in DELIVERIES.values()), strict=True)))
#: The ledger is seeded with what was published before.
SEEDED, NOW = datetime(2025, 3, 2, 12, tzinfo=UTC), datetime(2025, 3, 4, 12, tzinfo=UTC)


def deliver(root: Path, d: Delivery) -> Path:
    """Publish a file five minutes after its stamp."""
    path = root / "csb/csv" / d.when.strftime("%Y/%m/%d") / d.name
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [",".join(struct(PUBLISHED).names)]
    lines += [f"{d.boat},-,{r.lon},{r.lat},{r.depth},{r.time},a boat,{d.provider}" for r in d.readings]
    path.write_text("\n".join(lines) + "\n")
    published = (d.when + timedelta(minutes=5)).timestamp()
    os.utime(path, (published, published))
    return path


def publish(root: Path, *which: str) -> dict[str, Path]:
    return {name: deliver(root, DELIVERIES[name]) for name in which or DELIVERIES}


def voyage() -> Delivery:
    """Gull: twelve minutes at about ten knots to the east, eight at anchor, and one lone minute later; four readings each."""
    start, lon, rows = datetime(2025, 3, 3, 14, tzinfo=UTC), 11.0, []
    for minute in (*range(20), 40):
        lon += 0.005 if minute < 12 else 0.0
        for k in range(4):
            rows.append(Reading((start + timedelta(minutes=minute, seconds=15 * k)).strftime("%Y-%m-%dT%H:%M:%SZ"), f"{lon:.4f}", "55.2000", f"{20 + minute}.{k}"))
    return Delivery("20250303230500", "gull", "sound", tuple(rows), (84, 84, 0, 0))


VOYAGE_MINUTES = (12, 8, 1, 84)
