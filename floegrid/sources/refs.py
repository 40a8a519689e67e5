"""Input references from listings, catalogues and user-defined source types."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from floegrid.functions.names import TIFF_SUFFIX
from floegrid.sources.granules import granule_links, newest_links, read_granule_pages
from floegrid.sources.objects import INPUT_REF, object_refs, scan_objects

BUILT_IN = ("s3", "cmr")
_REGISTERED: set[str] = set()


class InputSource:
    """Protocol of a user-defined source type.

    `splits` names independent parts, each listed by its own task; `list_inputs` yields
    (url, name, auth_kind, metadata) of one part. Construction must be cheap.
    """

    kind: str = ""

    def __init__(self, options: dict[str, str]):
        self.options = options

    @property
    def description(self) -> str:
        return f"{self.kind}({', '.join(f'{k}={v}' for k, v in sorted(self.options.items()))})"

    def splits(self) -> list[str]:
        return [""]

    def list_inputs(self, split: str) -> Iterator[tuple[str, str, str, dict[str, str]]]:
        raise NotImplementedError


def register_input_source(spark: SparkSession, cls: type[InputSource]) -> None:
    """Make a source type readable as `spark.read.format(cls.kind)` and through input_refs."""
    if not cls.kind or cls.kind in BUILT_IN:
        raise ValueError(f"source type {cls.kind!r} cannot be registered")

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.source = cls(dict(options))

        def partitions(self):
            return [InputPartition(s) for s in self.source.splits()]

        def read(self, partition):
            yield from self.source.list_inputs(partition.value)

    class Source(DataSource):
        @classmethod
        def name(cls_):
            return cls.kind

        def schema(self):
            return INPUT_REF

        def reader(self, schema):
            return Reader(self.options)
    spark.dataSource.register(Source)
    _REGISTERED.add(cls.kind)


class Inventory(InputSource):
    """Inventory files as storage services write them: one JSON object a line with key and etag; each file is one task's work.

    Options: path, a folder of any file system that Arrow opens, and base, which goes before each key.
    """

    kind = "inventory"

    def _files(self):
        from pyarrow import fs
        return fs.FileSystem.from_uri(self.options["path"])

    def splits(self) -> list[str]:
        from pyarrow import fs
        system, folder = self._files()
        return sorted(f.path for f in system.get_file_info(fs.FileSelector(folder, recursive=True))
                      if f.is_file and not f.base_name.startswith(("_", ".")))

    def list_inputs(self, split: str) -> Iterator[tuple[str, str, str, dict[str, str]]]:
        import io
        import json
        system, _ = self._files()
        with system.open_input_stream(split) as raw:
            for line in io.TextIOWrapper(raw, "utf-8"):
                row = json.loads(line)
                yield self.options.get("base", "") + row["key"], row["key"].rsplit("/", 1)[-1], "s3", {"etag": row["etag"]}


def parse_bbox(text: str) -> tuple[float, float, float, float]:
    try:
        west, south, east, north = (float(x) for x in text.split(","))
    except ValueError:
        raise ValueError(f"bbox must be 'west,south,east,north', got {text!r}") from None
    return west, south, east, north


def _day(text: str) -> date:
    return date.fromisoformat(text[:10])


def input_refs(spark: SparkSession, kind: str = "s3", **options: Any) -> DataFrame:
    """References (url, name, auth_kind, metadata) of one source, with validated options.

    s3: prefix, include, exclude, limit; sorted by name.
    cmr: path of catalogue pages, short_name, start and end together, bbox, limit; newest first.
    Any registered type: its own options.
    """
    if kind == "s3":
        if not options.get("prefix"):
            raise ValueError("source type s3 needs a prefix")
        found = scan_objects(spark, options["prefix"], options.get("include"), options.get("exclude"),
                             options.get("limit"))
        return object_refs(found)
    if kind == "cmr":
        if not options.get("short_name") or not options.get("path"):
            raise ValueError("source type cmr needs a short_name and a path of catalogue pages")
        if bool(options.get("start")) != bool(options.get("end")):
            raise ValueError("start and end must be set together")
        from floegrid.sources.granules import filter_items
        pages = read_granule_pages(spark, options["path"])
        pages = filter_items(
            pages, [options["short_name"]],
            parse_bbox(options["bbox"]) if options.get("bbox") else None,
            (_day(options["start"]), _day(options["end"])) if options.get("start") else None,
            options.get("granule_ids"))
        links = granule_links(pages, options.get("extension", TIFF_SUFFIX), options.get("include"))
        return newest_links(links, options.get("limit"))
    if kind in _REGISTERED:
        return spark.read.format(kind).options(**{k: str(v) for k, v in options.items()}).load()
    raise ValueError(f"unsupported source type {kind!r}")
