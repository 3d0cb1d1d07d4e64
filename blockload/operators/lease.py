"""One driver at a time works on the runs of a process and scope.

A lease is a numbered file beside the ledger, created so that one of several
drivers gets a number. Its number is the fence of every event that its holder
records: a later holder's events come after all of an earlier one's, so
what a driver that lost its lease still writes is ignored by ``ledger_state``. A
holder renews its lease from a thread while it works and marks its end; a lease
that is neither ended nor renewed for ``lease_s`` seconds, as after a crash, can
be taken over. Times are those of the drivers' clocks.
"""

from __future__ import annotations

import contextlib
import threading
import time
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import SparkSession

from blockload.session import create_exclusive, listed, touch

_LEASES = "_leases"   # a hidden folder beside the events
_ENDED = ".ended"


class LeaseHeld(ValueError):
    """Another driver works on the runs of this process and scope."""


class LeaseLost(ValueError):
    """This driver's lease was taken over; it must not go on."""


class Lease:
    def __init__(self, spark: SparkSession, folder: str, fence: int) -> None:
        self.spark, self.folder, self.fence = spark, folder, fence
        self.path = f"{folder}/{fence:012d}"
        self._over = threading.Event()

    def check(self) -> None:
        """Raise if a later lease exists."""
        last = _last(self.spark, self.folder)[0]
        if last != self.fence:
            raise LeaseLost(f"lease {self.fence} of {self.folder} was taken over by lease {last}")

    def renew(self) -> None:
        touch(self.spark, self.path, time.time())

    def keep(self, seconds: float) -> None:
        """Renew every ``seconds`` until the end."""
        while not self._over.wait(seconds):
            with contextlib.suppress(Exception):  # the next renewal may succeed; check() decides
                self.renew()

    def end(self) -> None:
        self._over.set()
        create_exclusive(self.spark, self.path + _ENDED)


def _folder(ledger: str, process_name: str, scope: str) -> str:
    name = "~~".join(quote(n, safe="").replace("~", "%7E").replace("%", "~") for n in (process_name, scope))
    return f"{ledger}/{_LEASES}/l-{name}"


def _last(spark: SparkSession, folder: str) -> tuple[int, float, bool]:
    """Number and time of the latest lease, and whether it has ended."""
    names = listed(spark, folder)
    numbers = [int(n) for n in names if n.isdigit()]
    if not numbers:
        return 0, 0.0, True
    last = max(numbers)
    return last, names[f"{last:012d}"], f"{last:012d}{_ENDED}" in names


def take_lease(spark: SparkSession, ledger: str, process_name: str, scope: str, lease_s: float) -> Lease:
    folder = _folder(ledger, process_name, scope)
    last, renewed, ended = _last(spark, folder)
    age = time.time() - renewed
    if not ended and age < lease_s:
        raise LeaseHeld(f"another driver works on {process_name}/{scope} (lease {last}, renewed {age:.0f} s ago); "
                        f"a driver that is gone can be replaced {lease_s:.0f} s after its last renewal")
    lease = Lease(spark, folder, last + 1)
    if not create_exclusive(spark, lease.path):
        raise LeaseHeld(f"another driver took lease {last + 1} of {process_name}/{scope} first")
    return lease


_HELD = threading.local()


@contextlib.contextmanager
def leased(spark: SparkSession, ledger: str, process_name: str, scope: str, lease_s: float) -> Iterator[Lease]:
    """Hold the lease while this lasts. Calls inside each other share it."""
    held = _HELD.__dict__
    key = _folder(ledger, process_name, scope)
    if key in held:
        yield held[key]
        return
    lease = held[key] = take_lease(spark, ledger, process_name, scope, lease_s)
    threading.Thread(target=lease.keep, args=(max(0.2, lease_s / 4),), daemon=True).start()
    try:
        yield lease
    finally:
        del held[key]
        lease.end()
