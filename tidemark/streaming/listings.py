"""Change events derived from repeated listings of a store that does not report its changes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "path string, event string, ts timestamp, hash string"
BUCKETS = 256
_ROWS = ["path", "seen", "hash", "mtime"]
_HELD = pa.schema([("path", pa.string()), ("seen", pa.int64()), ("hash", pa.string()), ("mtime", pa.int64())])


def _packed(files: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(files, schema=_HELD, preserve_index=False)
    with pa.ipc.new_stream(sink, _HELD) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def _steps(held: pd.DataFrame, new: pd.DataFrame, grace: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Events `(path, event, seen, hash)` of new rows of many files after the held ones, and the last row of each file."""
    rows = pd.concat([held.assign(order=0), new.assign(order=1)], ignore_index=True)
    rows["mtime"] = rows["mtime"].fillna(-1).astype(np.int64)
    rows["code"] = pd.factorize(rows["path"], use_na_sentinel=False)[0]
    rows["none"] = rows["hash"].isna()
    rows["text"] = rows["hash"].where(~rows["none"], "")
    rows = rows.sort_values(["code", "seen", "order", "mtime", "text", "none"], kind="stable", ignore_index=True)
    # A row no newer than the newest one known of its file is late or repeated.
    known = rows["seen"].where(rows["order"] == 0).groupby(rows["code"]).transform("max")
    rows = rows[(rows["order"] == 0) | ~(rows["seen"] <= known)]
    rows = rows.drop_duplicates(["code", "seen"], ignore_index=True)

    code, seen = rows["code"].to_numpy(), rows["seen"].to_numpy()
    first, last = np.ones(len(rows), bool), np.ones(len(rows), bool)
    first[1:] = code[1:] != code[:-1]
    last[:-1] = first[1:]
    before = np.maximum(np.arange(len(rows)) - 1, 0)
    again = ~first & (seen - seen[before] > grace)
    text, none, mtime = rows["text"].to_numpy(), rows["none"].to_numpy(), rows["mtime"].to_numpy()
    differs = (text != text[before]) | (none != none[before]) | (mtime != mtime[before])
    added = (first & (rows["order"] == 1).to_numpy()) | again
    gone = rows.iloc[before[again]]
    told = [
        pd.DataFrame({"path": part["path"], "event": event, "seen": part["seen"], "hash": part["hash"] if event != "unlink" else None})
        for event, part in (("add", rows[added]), ("change", rows[~first & ~again & differs]), ("unlink", gone)) if len(part)
    ]
    return (pd.concat(told) if told else pd.DataFrame(columns=["path", "event", "seen", "hash"])), rows.loc[last, _ROWS]


def change_events(listings: DataFrame, every_ms: int, late: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """`(path, event, ts, hash)` of a stream of listings `(listed_at, path, hash, mtime)`: add, change and unlink.

    A listing names every file at one moment, and the next follows after `every_ms`. A file is added when it is listed first or
    again after a listing without it, changed when its hash or mtime differs from the listing before, and unlinked when a listing
    passes without it; `ts` is the time of the listing, for an unlink that of the last listing with the file.

    State is what is known of each file that is there: its hash, its mtime and when it was last listed. Files are held by the hash of
    their path in `buckets`, one row of state each, so that the work for a listing is that of whole columns and not of single files; a
    store of very many files takes more buckets, and the number stays as it is for the life of a checkpoint. A file is due half a
    period after it should have been listed again, and its bucket has a timer for the first that is: an unlink is told once the watermark
    (the newest listing less `late`) has passed, and the file leaves the state. Rows of one listing may come in any number of batches
    within `late`; repeated rows change nothing.
    """
    grace = every_ms * 3 // 2

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _unpacked(state.get[0]) if state.exists else _HELD.empty_table().to_pandas()
        new = [] if state.hasTimedOut else [f[_ROWS] for f in frames]
        told, files = _steps(held, pd.concat(new, ignore_index=True) if new else held.iloc[:0], grace)
        due = (files["seen"] + grace).to_numpy()
        over = due <= state.getCurrentWatermarkMs()
        gone, files = files[over], files[~over]
        if len(files):
            state.update((_packed(files),))
            state.setTimeoutTimestamp(int(due[~over].min()))
        elif state.exists:
            state.remove()
        unlinked = pd.DataFrame({"path": gone["path"], "event": "unlink", "seen": gone["seen"], "hash": None})
        out = pd.concat([f for f in (told, unlinked) if len(f)]) if len(told) or len(gone) else None
        if out is not None:
            yield pd.DataFrame({"path": out["path"], "event": out["event"], "ts": pd.to_datetime(out["seen"].astype(np.int64), unit="ms"), "hash": out["hash"]})

    rows = listings.withWatermark("listed_at", late).select(
        F.pmod(F.xxhash64("path"), F.lit(buckets)).cast("int").alias("bucket"),
        "path", "listed_at", F.unix_millis("listed_at").alias("seen"), "hash", F.unix_micros("mtime").alias("mtime"),
    )
    return rows.groupBy("bucket").applyInPandasWithState(follow, EVENTS, "files binary", "append", GroupStateTimeout.EventTimeTimeout)
