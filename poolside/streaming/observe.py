"""Streams of observations: what changed since the last accepted state, and replay-safe applies."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.dedup import pick_first
from ..operators.delta import upsert
from ..sources.tables import PartitionedTable

CHANGES = "live_id string, observation long, key string, state string, hash string, added long, removed long, changed long, unchanged long"


class Observed(StatefulProcessor):
    """ST1, DQ10: per watched source the accepted baseline and what was seen last, as maps of key to hash.

    An observation is complete: a key that it lacks was removed. One that removes
    something, or has problems of its own (undated or ambiguous results, sessions without a date),
    is held and does not replace the baseline, so the next one is compared with
    what was accepted; an empty one is never accepted. A release accepts what was seen last.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.accepted = handle.getMapState("accepted", "key string", "hash string")
        self.seen = handle.getMapState("seen", "key string", "hash string")

    @staticmethod
    def _all(state) -> dict[str, str]:  # noqa: ANN001
        return {k[0]: v[0] for k, v in state.iterator()}

    @staticmethod
    def _put(state, rows: dict[str, str]) -> None:  # noqa: ANN001
        state.clear()
        for k, v in rows.items():
            state.updateValue((k,), (v,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803, ANN001
        found: dict[int, dict[str, str]] = {}
        problems: dict[int, int] = {}
        released: set[int] = set()
        for frame in rows:  # one source's rows of a batch: a meet's results
            for n, k, h, p, r in zip(frame["observation"], frame["key"], frame["hash"], frame["problems"], frame["release"], strict=True):
                own = found.setdefault(int(n), {})
                problems[int(n)] = problems.get(int(n), 0) + int(p or 0)
                if r:
                    released.add(int(n))
                if k is not None and k == k:  # no NaN
                    own[k] = h
        out: list[tuple] = []
        before = self._all(self.accepted)
        for n in sorted(found):
            if n in released:
                before = self._all(self.seen)
                self._put(self.accepted, before)
                out.append((key[0], n, None, "released", None, 0, 0, 0, len(before)))
                continue
            after = found[n]
            states = {k: "added" if k not in before else "changed" if before[k] != h else "unchanged" for k, h in after.items()} | {k: "removed" for k in before if k not in after}
            count = lambda s: sum(v == s for v in states.values())  # noqa: E731, B023
            added, removed, changed, unchanged = map(count, ("added", "removed", "changed", "unchanged"))
            held = removed or problems[n]
            decision = "held" if held else "waiting" if not after else "new" if not before else "changed" if added or changed else "unchanged"
            out.append((key[0], n, None, decision, None, added, removed, changed, unchanged))
            out += [(key[0], n, k, s, after.get(k), None, None, None, None) for k, s in sorted(states.items()) if s != "unchanged"]
            self._put(self.seen, after)
            if after and not held:
                self._put(self.accepted, after)
                before = after
        yield pd.DataFrame(out, columns=[c.split()[0] for c in CHANGES.split(", ")]).astype({c: "Int64" for c in ("added", "removed", "changed", "unchanged")})

    def close(self) -> None:
        pass


def observed_changes(observations: DataFrame) -> DataFrame:
    """ST1: decisions and changes of a stream of (live_id, observation, key, hash, problems, release). Needs the RocksDB state store.

    A row without a key stands for an observation without results, or carries its problems,
    or releases what is held. Each observation gives a row with its decision and counts, and one
    for each key that was added, changed or removed.
    """
    return observations.groupBy("live_id").transformWithStateInPandas(Observed(), CHANGES, "Append", "None")


def observations(spark: SparkSession, folder: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    """ST3: a file stream in bounded batches; files beyond a batch wait for the next."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(folder)


def apply_batches(stream: DataFrame, table: PartitionedTable, keys: list[str], checkpoint: str, order: str = "strength") -> StreamingQuery:
    """ST2, ST4, ST5: upsert each micro-batch into the partitions that it touches, then stop.

    Within a batch the strongest evidence of a key wins, against the stored row too;
    late rows are never dropped. keys include the partition columns. A replayed batch
    changes nothing, for the upsert is idempotent by key; one that was interrupted left no version.
    """

    def merge(batch: DataFrame, number: int) -> None:  # noqa: ARG001
        if batch.isEmpty():
            return
        values = [c for c in batch.columns if c not in keys]
        best = pick_first(batch, keys, [F.desc_nulls_last(order), *(F.desc(c) for c in values)])
        if table.version() == 0:
            table.publish(best)
            return
        target = table.read(partitions=best)
        weaker = best.join(target.select(*keys, F.col(order).alias("_held")), keys).where(F.col(order) < F.col("_held")).select(*keys)
        table.publish(upsert(target, best.join(weaker, keys, "left_anti"), keys))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
