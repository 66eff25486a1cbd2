"""A stream over a folder into which archives arrive, by bytes a batch, each member once.

Archives are taken in the order in which they are found (those found together by path), and a batch ends at a place:
an archive's number and a byte of it.  A zip may be cut anywhere, a member belonging to the batch that holds the
first byte of its entry; other archives go into one batch whole, since their entries cannot be found from the
middle.  An archive must appear complete (renamed into place, or under a name that the pattern misses until then), as
its size is noted when it is found.

The option ``log`` names a folder of the stream's own, beside its checkpoint: it holds which archive has which number
and how far batches have been admitted, written before a place is given to Spark, so that a restarted stream reads the
same bytes for the same batch.  A member of a damaged archive is skipped with a warning, like in a scan.
"""

from __future__ import annotations

import json
from typing import Any

from pyarrow import fs
from pyspark.sql.datasource import DataSourceStreamReader, InputPartition

from corpusloom.sources.archives import ZIPS, MemberReader, list_archives, stretches, system_of

#: Bytes of archives of a batch, unless ``maxBytesPerTrigger`` says otherwise.
BATCH = 16 << 30
#: Entries of the log after which it is folded into one.
FOLD = 100
Found = list[tuple[str, int]]
Place = tuple[int, int]


class ArrivalLog:
    """Archives in the order of their arrival and the place up to which they have been admitted."""

    def __init__(self, folder: str):
        self.system, self.folder = system_of(folder)
        self.system.create_dir(self.folder, recursive=True)
        self.archives: Found = []
        self.admitted: Place = (0, 0)
        self.entries: list[str] = []
        for name in self._names():
            with self.system.open_input_stream(f"{self.folder}/{name}") as file:
                entry = json.loads(file.read())
            if entry["whole"]:
                self.archives = []
            self.archives += [(path, size) for path, size in entry["archives"]]
            self.admitted = tuple(entry["admitted"])
            self.entries.append(name)
        self.known = {path for path, _ in self.archives}

    def _names(self) -> list[str]:
        files = self.system.get_file_info(fs.FileSelector(self.folder))
        return sorted(i.base_name for i in files if i.base_name.endswith(".json"))

    def add(self, found: Found, admitted: Place) -> None:
        """Write what is new; every FOLD entries all there is, after which the older ones go."""
        number = int(self.entries[-1].removesuffix(".json")) + 1 if self.entries else 0
        self.archives += found
        self.known |= {path for path, _ in found}
        self.admitted = admitted
        whole = len(self.entries) >= FOLD
        name = f"{number:012d}.json"
        entry = {"whole": whole, "archives": self.archives if whole else found, "admitted": admitted}
        with self.system.open_output_stream(f"{self.folder}/{name}.new") as file:
            file.write(json.dumps(entry).encode())
        self.system.move(f"{self.folder}/{name}.new", f"{self.folder}/{name}")
        if whole:
            for old in self.entries:
                self.system.delete_file(f"{self.folder}/{old}")
            self.entries = []
        self.entries.append(name)


def advance(archives: Found, start: Place, most: int) -> Place:
    """The place about ``most`` bytes behind ``start``: in a zip at the byte, else at the last whole archive, but one at least."""
    (k, at), left = start, most
    while k < len(archives) and left > 0:
        path, size = archives[k]
        rest = max(size - at, 0)
        if rest > left and path.endswith(ZIPS):
            return k, at + left
        if rest > left and left < most:
            break
        k, at, left = k + 1, 0, left - rest
    return k, at


class ArchiveStream(MemberReader, DataSourceStreamReader):
    """The reader; Spark keeps one on the driver, which lists names and sizes only, and sends it to tasks to read."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.most = int(options.get("maxBytesPerTrigger", options.get("maxbytespertrigger", BATCH)))
        if self.most < 1:
            raise ValueError("maxBytesPerTrigger must be at least 1")
        if "log" not in options:
            raise ValueError("a stream of archives needs the option log, a folder of its own")
        self.folder = options["log"]
        self.log: ArrivalLog | None = None
        self.given: Place | None = None
        self.planned = True

    def __getstate__(self) -> dict[str, Any]:
        """Tasks need no log."""
        return {**self.__dict__, "log": None}

    def _log(self) -> ArrivalLog:
        if self.log is None:
            self.log = ArrivalLog(self.folder)
        return self.log

    def initialOffset(self) -> dict[str, int]:
        return {"archive": 0, "place": 0}

    def latestOffset(self) -> dict[str, int]:
        """One step behind the last place, once that has been planned; what is noted in the log before it is given out."""
        log = self._log()
        if self.given is None or self.planned:
            found = [f for f in list_archives(self.pattern) if f[0] not in log.known]
            place = advance(log.archives + found, log.admitted, self.most)
            self.planned, self.given = place == log.admitted, place
            if found or not self.planned:
                log.add(found, place)
        return {"archive": self.given[0], "place": self.given[1]}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[InputPartition]:
        """Stretches of the archives between two places."""
        first, last = ((o["archive"], o["place"]) for o in (start, end))
        self.planned = self.planned or last == self.given
        parts = []
        archives = self._log().archives
        for k in range(first[0], min(last[0] + 1, len(archives))):
            path, size = archives[k]
            from_, to = first[1] if k == first[0] else 0, last[1] if k == last[0] else size
            if to > from_:
                parts += stretches(path, from_, to)
        return [InputPartition(p) for p in parts]
