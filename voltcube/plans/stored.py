"""Stored tables per input version: built and published once, then read."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from voltcube.params import CODE_VERSION
from voltcube.plans.roles import Roles
from voltcube.session import shared_dir
from voltcube.sources.store import WRITERS, Load, VersionedStore


def store_for(roles: Roles, kind: str) -> VersionedStore:
    """The store of one kind of tables for this input: its full path and files
    (names, lengths, times), the role parameters and the code version name it."""
    tag = hashlib.sha256(f"{roles.fingerprint}|{roles.p!r}|{CODE_VERSION}".encode()).hexdigest()[:32]
    return VersionedStore(roles.spark, f"{shared_dir(roles.spark)}/voltcube/stored/{kind}-{tag}")


def read_or_publish(roles: Roles, kind: str, names: Sequence[str], build: Callable[[Load], None], checks=None) -> dict[str, DataFrame]:
    """The named tables of the current version; the first caller writes them by ``build`` and publishes it."""
    store = store_for(roles, kind)
    version = store.current_version()
    if version is None:
        with Load(store) as load:
            build(load)
            version = load.commit(checks)
    return store.read_all(names, version)


def at_once(fns: Sequence[Callable[[], object]]) -> list:
    """Results of steps that do not depend on each other, some run at the same time (each is a Spark job or more)."""
    with ThreadPoolExecutor(WRITERS) as pool:
        return [f.result() for f in [pool.submit(fn) for fn in fns]]
