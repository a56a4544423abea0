"""Versioned Parquet releases: datasets flat and partitioned, manifest, contracts, dictionary, pointer."""

from __future__ import annotations

import json
import os
import re
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.descriptions import describe
from ..operators.quality import CONTRACT_VERSION, CONTRACTS, check_all, contract_of, enforce, key_problems
from ..session import materialise
from ..sources import files

# Rows above which a dataset is written as a folder of files: one task should not carry a whole large table.
SINGLE_FILE_ROWS = 20_000_000

class ReleaseError(RuntimeError):
    """A release that can't be made."""


def release_version(text: str) -> str:
    """1.2.3 and v1.2.3 as v1.2.3; anything else is refused."""
    m = re.fullmatch(r"v?(\d+\.\d+\.\d+(?:[-+][0-9A-Za-z.-]+)?)", text.strip())
    if not m:
        raise ValueError(f"not a version: {text!r}")
    return f"v{m[1]}"


def file_checksum(path: str | os.PathLike) -> str:
    return files.checksum(path)


def partition_name(value: object) -> str:
    return "__NULL__" if value is None else str(value)


def _spark_path(path: str) -> str:
    """The path as Spark takes it: one without scheme is a file, whatever the cluster's default is."""
    return path if "://" in path else f"file://{os.path.abspath(path)}"


def write_single(df: DataFrame, target: str | os.PathLike, rows: int | None = None) -> dict:
    """One zstd Parquet file of a released table, for readers that know no folders; a table of more than SINGLE_FILE_ROWS rows is a folder of files under the same name."""
    target = os.fspath(target)
    folder, name = target.rsplit("/", 1)
    few = (df.count() if rows is None else rows) <= SINGLE_FILE_ROWS
    scratch = f"{folder}/.{name}.tmp"
    (df.coalesce(1) if few else df).write.mode("overwrite").option("compression", "zstd").parquet(_spark_path(scratch))
    parts = files.files_below(scratch, ".parquet")
    if few:
        files.move(f"{scratch}/{parts[0][0]}", target)
        files.remove(scratch)
        return {"file": name, "size_bytes": parts[0][1], "sha256": files.checksum(target)}
    files.move(scratch, target)
    return {"file": name, "size_bytes": sum(n for _, n in parts), "parts": [{"path": p, "size_bytes": n, "sha256": files.checksum(f"{target}/{p}")} for p, n in parts]}


def write_partitioned(df: DataFrame, by: tuple[str, ...], target: str | os.PathLike) -> list[dict]:
    """One folder per key. Rows of a key are brought together first, so that each folder holds few files; a key with very many rows is split by the adaptive planner."""
    target = os.fspath(target)
    # Spark names the folder of a null key itself, so it is written as its own value
    keyed = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("__NULL__")) for c in by})
    keyed.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).option("compression", "zstd").parquet(_spark_path(target))
    return [{"path": p, "size_bytes": n, "sha256": files.checksum(f"{target}/{p}")} for p, n in files.files_below(target, ".parquet")]


def data_dictionary(tables: dict[str, DataFrame], rows: dict[str, int] | None = None) -> dict:
    """What each table holds: its meaning and grain, keys, counts, and every column with type, whether the contract asks for it, and its meaning."""
    out = {}
    for name, df in tables.items():
        c = CONTRACTS.get(name)
        out[name] = {
            "description": c.description if c else "", "grain": c.grain if c else "", "row_count": (rows or {}).get(name) if rows else df.count(), "column_count": len(df.columns),
            "key": list(c.key) if c else [], "partition_by": list(c.partition) if c else [],
            "columns": [{"name": f.name, "type": f.dataType.simpleString(), "required": bool(c and f.name in c.columns), "description": describe(f.name)} for f in df.schema],
        }
    return out


def dictionary_text(dictionary: dict) -> str:
    lines = ["# Data dictionary", ""]
    for name, of in dictionary.items():
        lines += [f"## {name}", "", f"{of['description']} {of['grain']}".strip(), "", f"{of['row_count']} rows. Key: {', '.join(of['key']) or 'none'}.", "", "| column | type | required | description |", "| --- | --- | --- | --- |"]
        lines += [f"| {c['name']} | {c['type']} | {'yes' if c['required'] else ''} | {c['description']} |" for c in of["columns"]] + [""]
    return "\n".join(lines)


def contracts_json() -> dict:
    return {
        "version": CONTRACT_VERSION,
        "datasets": {n: {"description": c.description, "grain": c.grain, "columns": c.columns, "primary_key": list(c.key), "partition_by": list(c.partition), "duplicates": "counted" if c.lenient else "refused"} for n, c in CONTRACTS.items()},
    }


# The rules by which a release is made and read, as the manifest states them.
RELEASE_RULES = {
    "immutability": "A published version does not change; it is rebuilt only by force.",
    "validation": "No finding of level ERROR and no broken contract.",
    "checksums": "SHA-256 of every data file.",
    "pointer": "latest.json names the newest release of this root and is moved after the release is whole.",
    "null_partition": "__NULL__ stands for a null key in the names of partition folders.",
}


def publish(tables: dict[str, DataFrame], version: str, root: str | os.PathLike, force: bool = False, validate: bool = True, pointer: bool = True) -> str | Path:
    """Writes root/<version> whole or not at all; an existing version is kept unless ``force``.

    ``root`` is a local or mounted folder or a URI. Rule findings of level ERROR
    and broken contracts stop the release before anything is written there.
    Each table is computed once. ``pointer``: whether latest.json of this root
    is moved to the release; scratch releases leave it alone.
    """
    name, base = release_version(version), os.fspath(root)
    target = f"{base}/{name}"
    if files.exists(target) and not force:
        raise ReleaseError(f"release {name} exists and releases don't change; force rebuilds it")
    tables = {n: materialise(df) for n, df in tables.items()}
    counts = {"ERROR": 0, "WARNING": 0, "INFO": 0}
    if validate:
        counts |= {r["level"]: r["count"] for r in check_all(tables).groupBy("level").count().collect()}
        if counts["ERROR"]:
            raise ReleaseError(f"{counts['ERROR']} validation errors")
    enforce(tables)
    scratch = f"{base}/.{name}.tmp"
    files.remove(scratch)
    try:
        files.make_folder(f"{scratch}/datasets")
        rows = {n: df.count() for n, df in tables.items()}
        dictionary = data_dictionary(tables, rows)
        entries = []
        for table, df in tables.items():
            entry = {"dataset": table, "row_count": rows[table], "column_count": len(df.columns), **write_single(df, f"{scratch}/datasets/{table}.parquet", rows[table])}
            contract = contract_of(table)
            if contract.lenient:
                entry["duplicate_keys"] = key_problems(contract, df)
            entries.append(entry | {"partitions": write_partitioned(df, contract.partition, f"{scratch}/partitioned/{table}") if contract.partition else []})
        files.write_json(contracts_json(), f"{scratch}/contracts.json")
        files.write_json(dictionary, f"{scratch}/data_dictionary.json")
        files.write_text(dictionary_text(dictionary), f"{scratch}/data_dictionary.md")
        files.write_json({"release_version": name, "created_at": datetime.now(UTC).isoformat(), "rules": RELEASE_RULES, "dataset_count": len(entries), "total_rows": sum(rows.values()), "validation": counts, "datasets": entries}, f"{scratch}/manifest.json")
        files.remove(target)
        files.move(scratch, target)
    except BaseException:
        files.remove(scratch)
        raise
    if pointer:
        files.write_json({"latest": name}, f"{base}/latest.json")
    return target if "://" in target else Path(target)


def latest_release(root: str | os.PathLike) -> str:
    """The version latest.json names, if it is there."""
    pointer = f"{os.fspath(root)}/latest.json"
    if not files.exists(pointer):
        raise ReleaseError(f"{pointer} is missing: nothing has been published here")
    return release_version(json.loads(files.read_text(pointer))["latest"])


def export_marts(marts: dict[str, DataFrame], version: str | None, release_root: str | os.PathLike) -> dict:
    """The marts as files beside a release's datasets (the latest release without ``version``), with a manifest."""
    name, root = release_version(version) if version else latest_release(release_root), os.fspath(release_root)
    if not files.exists(f"{root}/{name}/datasets"):
        raise ReleaseError(f"no datasets of release {name}")
    target = f"{root}/{name}/analytics"
    files.make_folder(target)
    entries = []
    for mart, df in marts.items():
        df = materialise(df)
        rows = df.count()
        entries.append({"mart": mart, "row_count": rows, "column_count": len(df.columns), "columns": df.columns, **write_single(df, f"{target}/{mart}.parquet", rows)})
    manifest = {"release_version": name, "created_at": datetime.now(UTC).isoformat(), "dataset_count": len(entries), "datasets": entries}
    files.write_json(manifest, f"{target}/manifest.json")
    return manifest


def release_tables(spark: SparkSession, root: str | os.PathLike, version: str | None = None) -> dict[str, DataFrame]:
    """The datasets of a release, the latest without ``version``."""
    name = release_version(version) if version else latest_release(root)
    found = sorted({p.split("/")[0] for p, _ in files.files_below(f"{os.fspath(root)}/{name}/datasets")})
    return {p.removesuffix(".parquet"): spark.read.parquet(_spark_path(f"{os.fspath(root)}/{name}/datasets/{p}")) for p in found if p.endswith(".parquet")}
