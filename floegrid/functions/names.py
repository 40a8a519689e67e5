"""Column functions over object names, keys and URLs."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# The file name families whose acquisition time can be read from the name,
# in the order they are tried, with the time format of the captured group. Six-digit
# groups are months and are completed to their first day.
TIME_PATTERNS = (
    (r"SWOT_L2_LR_NPFRB_\d+_\d+_(\d{8}T\d{6})", "yyyyMMdd'T'HHmmss"),
    (r"(?i)swot_bin_(\d{8})", "yyyyMMdd"),
    (r"(?i)swot_bin_(\d{6})", "yyyyMM"),
    (r"S1[A-D]_\w+_\w+_\w+_(\d{8}T\d{6})_\d{8}T\d{6}", "yyyyMMdd'T'HHmmss"),
    (r"icesat2_bin_(\d{8})", "yyyyMMdd"),
    (r"icesat2_bin_(\d{6})", "yyyyMM"),
)
SENTINEL_TIME = r"S1[A-D]_\w+_\w+_\w+_(\d{8}T\d{6})_\d{8}T\d{6}"
GRANULE_NAME = r"^(S1[A-D])_(\w+?)_(\w+?)_(\w+?)_(\d{8}T\d{6})_"
# Collection suffix to the product-type token used in product names.
PRODUCT_TYPE_TOKENS = {"GRD_MEDIUM": "_GRDM_", "GRD_HIGH": "_GRDH_", "GRD_FULL": "_GRDF_"}
TIFF_SUFFIX = r"(?i)\.tiff?$"


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def glob_to_regex(pattern: str) -> str:
    """A case-sensitive shell glob as an anchored Java regex."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1:close].replace("\\", r"\\").replace("[", r"\[").replace("&&", r"&\&")
            if body[0] == "!":
                body = "^" + body[1:]
            elif body[0] == "^":
                body = "\\" + body
            out.append(f"[{body}]")
            i = close
        else:
            out.append(re.escape(c))
        i += 1
    return "(?s)^" + "".join(out) + "$"


def glob_match(name: Column, pattern: str | None) -> Column:
    if not pattern or pattern == "*":
        return F.lit(True)
    return name.rlike(glob_to_regex(pattern))


def _compact_time(text: Column, fmt: str) -> Column:
    if fmt == "yyyyMM":
        text, fmt = F.when(text != "", F.concat(text, F.lit("01"))), "yyyyMMdd"
    return F.try_to_timestamp(text, F.lit(fmt))


def _user_regex(regex: str) -> tuple[str, int]:
    """A Java form of a Python pattern and the ordinal of its time group (0 if it has none)."""
    compiled = re.compile(regex)
    group = compiled.groupindex.get("start_date", 1 if compiled.groups else 0)
    return re.sub(r"\(\?P<\w+>", "(", regex), group


# ISO dates and times; a bare clock time or year is none, although a cast would take it.
ISO_TIME = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?([zZ]|[+-]\d{2}(:?\d{2})?)?)?$")


def acq_time(name: Column, mtime: Column | None = None, regex: str | None = None) -> Column:
    """Acquisition time read from a file name, falling back to the modification time.

    A user pattern that matches decides the result, even when what it captured is no date;
    one that does not match leaves the built-in families to decide.
    """
    found = F.coalesce(*(_compact_time(F.regexp_extract(name, p, 1), f) for p, f in TIME_PATTERNS))
    if regex:
        java, group = _user_regex(regex)
        text = F.regexp_extract(name, java, group)
        parsed = (F.when(F.length(text) == 8, F.try_to_timestamp(text, F.lit("yyyyMMdd")))
                  .when((F.length(text) == 15) & text.contains("T"),
                        F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmss")))
                  .when(text.rlike(ISO_TIME), text.try_cast("timestamp")))
        parsed = parsed if group else F.lit(None).cast("timestamp")
        found = F.when(name.rlike(java), parsed).otherwise(found)
    return found if mtime is None else F.coalesce(found, mtime)


# strptime tokens accepted in a catalogue time format and their Java letters.
_TIME_TOKENS = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss",
                "%j": "DDD", "%y": "yy", "%I": "hh", "%p": "a", "%f": "SSSSSS", "%T": "HH:mm:ss"}


def java_time_format(fmt: str) -> tuple[str, bool]:
    """A strptime format as a Java pattern, and whether it carries a time of day."""
    out, clock = [], False
    for part in re.findall(r"%.|[A-Za-z]+|[^A-Za-z%]+", fmt):
        if part.startswith("%"):
            if part not in _TIME_TOKENS:
                raise ValueError(f"unsupported time token {part} in {fmt}")
            clock |= part[1] in "HMSTIfp"
            out.append(_TIME_TOKENS[part])
        else:
            out.append(f"'{part}'" if part.isalpha() else part)
    return "".join(out), clock


def catalog_time(name: Column, regex: str | None = None, fmt: str = "%Y%m%dT%H%M%S") -> Column:
    """Catalogue time of a file: radar names first, then the user pattern; date-only
    formats are placed at noon."""
    sentinel = F.try_to_timestamp(F.regexp_extract(name, SENTINEL_TIME, 1),
                                  F.lit("yyyyMMdd'T'HHmmss"))
    if not regex:
        return sentinel
    java, group = _user_regex(regex)
    if not group:
        return sentinel
    pattern, clock = java_time_format(fmt)
    user = F.try_to_timestamp(F.regexp_extract(name, java, group), F.lit(pattern))
    if not clock:
        user = user + F.make_interval(hours=F.lit(12))
    return F.coalesce(sentinel, user)


def parse_granule_name(name: Column) -> Column:
    """Struct of satellite, mode, product, polarisation and start; null if the name differs."""
    def part(i: int) -> Column:
        return F.regexp_extract(name, GRANULE_NAME, i)
    return F.when(name.rlike(GRANULE_NAME), F.struct(
        part(1).alias("satellite"), part(2).alias("mode"), part(3).alias("product"),
        part(4).alias("polarisation"),
        F.try_to_timestamp(part(5), F.lit("yyyyMMdd'T'HHmmss")).alias("start")))


def platform_and_type(short_name: Column, strict: bool = True) -> Column:
    """Platform prefix and product-type token of a collection short name."""
    upper = F.upper(short_name)
    letter = F.regexp_extract(upper, r"^SENTINEL-1([A-Z])", 1)
    token = F.lit(None).cast("string")
    for suffix, value in PRODUCT_TYPE_TOKENS.items():
        token = F.when(upper.endswith(suffix), F.lit(value)).otherwise(token)
    pair = F.when((letter != "") & token.isNotNull(),
                  F.struct(F.concat(F.lit("S1"), letter).alias("platform"), token.alias("token")))
    if strict:
        pair = F.coalesce(pair, F.raise_error(
            F.concat(F.lit("no platform or product type in short name "), short_name)))
    return pair


def parse_uri(uri: Column, strict: bool = True) -> Column:
    """Bucket and key of an s3:// path."""
    parsed = F.when(uri.startswith("s3://"), F.struct(
        F.regexp_extract(uri, r"^s3://([^/]*)", 1).alias("bucket"),
        F.regexp_extract(uri, r"(?s)^s3://[^/]*/(.*)$", 1).alias("key")))
    if strict:
        parsed = F.coalesce(parsed, F.raise_error(F.concat(F.lit("not an s3 path: "), uri)))
    return parsed


def http_to_s3(url: Column) -> Column:
    """An s3:// path from a path-style or virtual-host object URL, else null."""
    path_style = r"^https?://s3\.amazonaws\.com/([^/]+)/(.*)"
    virtual = r"^https?://([^.]+)\.s3\.amazonaws\.com/(.*)"

    def uri(pattern: str) -> Column:
        return F.concat(F.lit("s3://"), F.regexp_extract(url, pattern, 1), F.lit("/"),
                        F.regexp_extract(url, pattern, 2))
    return F.when(url.rlike(path_style), uri(path_style)).when(url.rlike(virtual), uri(virtual))


def remap_path(path: Column, remove: str, replace: str = "") -> Column:
    """Substitute a leading `remove`, else its first occurrence."""
    at = F.instr(path, remove)
    return F.when(at > 0, F.concat(F.substring(path, F.lit(1), at - 1), F.lit(replace),
                                   F.substring(path, at + len(remove), F.length(path)))
                  ).otherwise(path)


def item_id(key: Column) -> Column:
    """Item id of a TIFF key: its name without the last suffix."""
    return F.when(key.rlike(TIFF_SUFFIX), F.regexp_replace(base_name(key), r"\.[^.]*$", ""))


def key_date(key: Column) -> Column:
    """Date of a /YYYY/MM/DD/ folder in a key, null where there is none."""
    pattern = r"/(\d{4})/(\d{2})/(\d{2})/"
    return F.to_date(F.try_to_timestamp(
        F.concat(*(F.regexp_extract(key, pattern, i) for i in (1, 2, 3))), F.lit("yyyyMMdd")))


def stem_date(key: Column, drop: str = "_full") -> Column:
    """Date in the last underscore token of a file stem; only eight digits count."""
    stem = F.regexp_replace(F.regexp_replace(base_name(key), r"\.[^.]*$", ""), drop, "")
    return F.to_date(F.try_to_timestamp(F.regexp_extract(stem, r"(?:^|_)(\d{8})$", 1),
                                        F.lit("yyyyMMdd")))


def ice_product_url(base: str, folder: str, stem: str, hemisphere: str, day: Column) -> Column:
    """Daily sea-ice file URL: folder, year, month, nominal 12:00 stamp."""
    return F.concat(F.lit(f"{base.rstrip('/')}/{folder}/"), F.date_format(day, "yyyy/MM"),
                    F.lit(f"/{stem}_{hemisphere}_polstere-100_multi_"),
                    F.date_format(day, "yyyyMMdd"), F.lit("1200.nc"))


def forecast_url(base: str, day: Column, run: int = 0, step: int = 0, resol: str = "0p25") -> Column:
    """Operational forecast file URL for a run hour and lead time."""
    ymd = F.date_format(day, "yyyyMMdd")
    return F.concat(F.lit(base.rstrip("/") + "/"), ymd, F.lit(f"/{run:02d}z/ifs/{resol}/oper/"), ymd,
                    F.lit(f"{run:02d}0000-{step}h-oper-fc.grib2"))


def dated_key(prefix: str, collection: Column, day: Column, filename: Column) -> Column:
    """<prefix>/<collection>/YYYY/MM/DD/<file>, slashes in the collection made safe."""
    parts = [F.replace(collection, F.lit("/"), F.lit("_")), F.date_format(day, "yyyy"),
             F.date_format(day, "MM"), F.date_format(day, "dd"), filename]
    if prefix:
        parts.insert(0, F.lit(prefix.strip("/")))
    return F.concat_ws("/", *parts)


def raster_prefix(prefix: str, collection: str) -> str:
    return "/".join(p for p in (prefix.strip("/"), collection) if p) + "/"


def cube_prefix(prefix: str, collection: str) -> str:
    return f"{raster_prefix(prefix, collection)}{collection}.zarr/"
