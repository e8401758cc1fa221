"""One ordered file without one task.

The result is range-partitioned, sorted and written in parallel, as for many files; then the store joins the parts
in their order into one file. A store with a concatenate call (HDFS) moves block lists and copies no byte. On the
local file system, which has none, the parts are appended to one another in this process, through a small buffer. Any other
store is refused: there, ask for many files, whose names follow the order.
"""

from __future__ import annotations

import os
import shutil
import uuid

from pyspark.sql import SparkSession


def join_parts(spark: SparkSession, parts: str, path: str, extension: str, header: str | None = None) -> None:
    """Join the part files of the folder ``parts`` in the order of their names into one file in the new folder ``path``, after a
    line ``header`` if given; ``parts`` is removed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    source, target = Path(parts), Path(path, f"part-00000-{uuid.uuid4().hex}{extension}")
    fs = source.getFileSystem(conf)
    found = sorted(f.getPath().toString() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-") and f.getLen())
    local = fs.getUri().getScheme() == "file"
    if not local and not fs.hasPathCapability(target, "fs.capability.paths.concat"):
        raise ValueError(f"{fs.getUri()} cannot join files; write many files instead")
    fs.mkdirs(Path(path))
    out = fs.create(target)
    if header is not None:
        out.write(bytearray((header + "\n").encode()))
    out.close()
    if local:
        # one writer for all bytes: the checksum file of the empty target goes with it
        with open(Path(target.toString()).toUri().getPath(), "ab") as joined:
            for f in found:
                with open(Path(f).toUri().getPath(), "rb") as part:
                    shutil.copyfileobj(part, joined, 1 << 20)
        crc = os.path.join(os.path.dirname(joined.name), f".{os.path.basename(joined.name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    elif found:
        sources = spark.sparkContext._gateway.new_array(Path, len(found))
        for k, f in enumerate(found):
            sources[k] = Path(f)
        fs.concat(target, sources)
    fs.create(Path(path, "_SUCCESS")).close()
    fs.delete(source, True)


def prepared(spark: SparkSession, path: str, mode: str) -> bool:
    """Whether to write to ``path`` under the save mode ``mode``; an old result is removed where it is to be replaced."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return True
    if mode == "ignore":
        return False
    if mode != "overwrite":
        raise ValueError(f"{path} exists already")
    return fs.delete(target, True)
