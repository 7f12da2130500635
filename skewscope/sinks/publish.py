"""A set of outputs published as one.

All artefacts are written under ``out/versions/<id>``; then a manifest that names each with its number of lines and a
checksum goes to ``out/manifests/<number>.json`` by one rename. Readers take the manifest with the greatest number, so they see the old set
or the new one, never a mixture, and a run that broke off is never seen.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewscope.plans import files


def line_sums(spark: SparkSession, path: str) -> tuple[int, int]:
    """Lines of a text artefact and the sum of their hashes, whatever the order of lines and files."""
    row = spark.read.text(path).agg(F.count(F.lit(1)).alias("n"),
                                    F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("s")).first()
    return int(row["n"]), int(row["s"] or 0)


def publish(spark: SparkSession, out: str, write: Callable[[str], None]) -> dict:
    """Call ``write(folder)`` and publish what it wrote there; returns the manifest."""
    out = out.rstrip("/")
    version = uuid.uuid4().hex
    folder = f"{out}/versions/{version}"
    write(folder)
    artefacts = {}
    for name in files.names(spark, folder):
        lines, checksum = line_sums(spark, f"{folder}/{name}")
        artefacts[name] = {"lines": lines, "checksum": str(checksum)}
    number = _last(spark, out)
    while True:
        number += 1
        manifest = {"number": number, "version": version, "artefacts": artefacts}
        try:
            files.write_text(spark, f"{out}/manifests/{number:08d}.json", json.dumps(manifest, indent=1))
            return manifest
        except FileExistsError:  # another run published meanwhile
            if number > _last(spark, out) + 1000:
                raise


def _last(spark: SparkSession, out: str) -> int:
    some = [n for n in files.names(spark, f"{out}/manifests") if n[:8].isdigit() and n.endswith(".json")]
    return int(some[-1][:8]) if some else 0


def current(spark: SparkSession, out: str) -> dict | None:
    """The manifest of the last published set."""
    out = out.rstrip("/")
    number = _last(spark, out)
    return json.loads(files.read_text(spark, f"{out}/manifests/{number:08d}.json")) if number else None


def artefact(spark: SparkSession, out: str, name: str) -> str:
    """The folder of an artefact of the last published set."""
    manifest = current(spark, out)
    if manifest is None or name not in manifest["artefacts"]:
        raise FileNotFoundError(f"{name} is not published under {out}")
    return f"{out.rstrip('/')}/versions/{manifest['version']}/{name}"


def verify(spark: SparkSession, out: str) -> DataFrame:
    """(artefact, lines, intact) of the last published set."""
    manifest = current(spark, out) or {"artefacts": {}}
    rows = []
    for name, want in manifest["artefacts"].items():
        lines, checksum = line_sums(spark, artefact(spark, out, name))
        rows.append((name, lines, lines == want["lines"] and str(checksum) == want["checksum"]))
    return spark.createDataFrame(rows, "artefact string, lines long, intact boolean")


def sweep(spark: SparkSession, out: str, keep: int = 2) -> int:
    """Delete all versions but the last ``keep`` published ones; only while nothing is being published."""
    out = out.rstrip("/")
    some = [n for n in files.names(spark, f"{out}/manifests") if n.endswith(".json")]
    kept = {json.loads(files.read_text(spark, f"{out}/manifests/{n}"))["version"] for n in some[-keep:]}
    return sum(files.delete(spark, f"{out}/versions/{v}") for v in files.names(spark, f"{out}/versions") if v not in kept)
