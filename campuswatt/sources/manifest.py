"""Versions of a table: which folders hold its parts, switched in one step.

Files of a write go to a folder of their own. Then one new manifest names, for every part of the table (a month
of a fact, or the whole dimension), the folders that hold it now. Readers go by the manifest with the highest
number, so a job that dies before it is written leaves the table as it was. A manifest also keeps the last batch
of every stream with its counters: rows and record become visible together.

A number can be taken once: of two writers that start from the same version, the later one fails. A manifest is
whole when its last line says so; half a manifest, left by a driver that died, is passed over.
"""

import json
import uuid

KEPT = 8        # versions whose files stay for readers that began with them
END = "end"


class Manifest:
    """number, parts {part: [folder]} and batches {stream: {batch, stats}} of one version."""

    def __init__(self, number=0, parts=None, batches=None):
        self.number, self.parts, self.batches = number, parts or {}, batches or {}

    def text(self):
        return json.dumps({"parts": self.parts, "batches": self.batches}) + "\n" + END


def _store(spark, path):
    """File system and path of a folder, on any storage Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark, folder):
    store, where = _store(spark, folder)
    return [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []


def _content(spark, path):
    store, where = _store(spark, path)
    stream = store.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _numbers(spark, root):
    return sorted((int(n) for n in _names(spark, f"{root}/_manifest") if n.isdigit()), reverse=True)


def _read(spark, root, number):
    body, _, end = _content(spark, f"{root}/_manifest/{number:010d}").rpartition("\n")
    return Manifest(number, **json.loads(body)) if end == END else None


def latest(spark, root):
    """The manifest in force; an empty one for a new table."""
    for number in _numbers(spark, root):
        found = _read(spark, root, number)
        if found is not None:
            return found
    return Manifest()


def commit(spark, root, manifest):
    """Put the next manifest in force; an error if another writer took its number."""
    taken = _numbers(spark, root)
    if taken and taken[0] > manifest.number:
        if any(_read(spark, root, n) is not None for n in taken if n > manifest.number):
            raise RuntimeError(f"{root} was changed by another writer")
        manifest.number = taken[0]      # numbers above are of manifests that were never finished
    manifest.number += 1
    store, where = _store(spark, f"{root}/_manifest/{manifest.number:010d}")
    out = store.create(where, False)    # fails if the file is there
    try:
        out.write(bytearray(manifest.text().encode()))
    finally:
        out.close()


def new_version(manifest):
    """Name of a folder for files of the next version."""
    return f"version={manifest.number + 1:010d}-{uuid.uuid4().hex[:12]}"


def parts_of(spark, folder, prefix):
    """Values of the partition folders ``prefix=value`` that a write left."""
    return [n[len(prefix) + 1:] for n in _names(spark, folder) if n.startswith(f"{prefix}=")]


def tidy(spark, root, kept=KEPT):
    """Delete files that none of the last ``kept`` versions names, and older manifests."""
    numbers = _numbers(spark, root)
    whole = [m for m in (_read(spark, root, n) for n in numbers[:kept]) if m is not None]
    if not whole or len(numbers) <= kept:
        return
    in_use = {folder for m in whole for folders in m.parts.values() for folder in folders}
    newest = f"version={numbers[0]:010d}"
    for name in _names(spark, root):
        if name.startswith("version=") and name not in in_use and name < newest:
            store, where = _store(spark, f"{root}/{name}")
            store.delete(where, True)
    for number in numbers[kept:]:
        store, where = _store(spark, f"{root}/_manifest/{number:010d}")
        store.delete(where, False)
