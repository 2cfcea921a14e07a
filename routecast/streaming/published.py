"""Records of a sink's batches, each seen whole or not at all.

A sink writes every attempt at a batch under a fresh name and then publishes
it with one small record. Readers follow records only: what an attempt left
that failed, or that a replay has replaced, is never read. A record is never
changed. The latest one of a batch counts, and every ``FOLD_EVERY``-th also
holds the state of all batches before it, so that a reader opens at most that
many files.

One writer at a time, as a sink belongs to one checkpoint. Folders are reached
by Arrow's file systems (local or mounted, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import time

from pyarrow import fs

from routecast.sources.segments import write_whole

FOLD_EVERY = 64


class BatchRecords:
    def __init__(self, path: str):
        self.files, root = fs.FileSystem.from_uri(path)
        self.sink = root.rstrip("/")
        self.root = f"{self.sink}/_batches"

    def _listed(self) -> list[str]:
        found = self.files.get_file_info(fs.FileSelector(self.root, allow_not_found=True))
        return sorted(f.base_name for f in found if f.base_name.endswith(".json"))

    def _fold(self, names: list[str]) -> dict[int, dict]:
        folded = [i for i, name in enumerate(names) if name.endswith(".all.json")]
        state: dict[int, dict] = {}
        for name in names[folded[-1] if folded else 0 :]:
            with self.files.open_input_stream(f"{self.root}/{name}") as f:
                state |= {int(n): record for n, record in json.loads(f.read()).items()}
        return state

    def read(self) -> dict[int, dict]:
        """The record of each published batch."""
        return dict(sorted(self._fold(self._listed()).items()))

    def publish(self, batch_id: int, record: dict) -> None:
        """Make ``record`` the one of the batch."""
        names = self._listed()
        at = int(names[-1].split(".")[0]) + 1 if names else 0
        whole = at % FOLD_EVERY == FOLD_EVERY - 1
        state = {**(self._fold(names) if whole else {}), int(batch_id): record}
        self.files.create_dir(self.root, recursive=True)
        write_whole(self.files, f"{self.root}/{at:020d}{'.all' if whole else ''}.json", json.dumps(state))

    def remove_unpublished(self, older_than_seconds: float) -> list[str]:
        """Delete the attempts that no record names and whose folder is older:
        no reader planned before still needs them, and no writer is at work on
        them. Returns their names."""
        kept = {record["attempt"] for record in self.read().values()}
        limit, gone = time.time() - older_than_seconds, []
        batches = self.files.get_file_info(fs.FileSelector(self.sink, allow_not_found=True))
        for batch in batches:
            if not batch.base_name.startswith("batch_id="):
                continue
            for attempt in self.files.get_file_info(fs.FileSelector(batch.path)):
                name = attempt.base_name.removeprefix("attempt=")
                if attempt.base_name != name and name not in kept and attempt.mtime.timestamp() <= limit:
                    self.files.delete_dir(attempt.path)
                    gone.append(name)
        return gone
