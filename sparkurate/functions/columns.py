"""Column functions of the curation domain: no user-defined function, all inside code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkurate.functions import values as V



def text(value: str) -> Column:
    return F.lit(value)


def strip(c: Column) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


# --- licences and kingdoms -------------------------------------------------------------------


def _compact_license(c: Column) -> Column:
    for old, new in (("creative commons", "cc"), ("creativecommons", "cc"), ("_", "-"), (" ", "")):
        c = F.replace(c, text(old), text(new))
    return c


def license_sql(c: Column) -> Column:
    """The licence code as the metadata stage reads it: replacements first, lower-cased last."""
    known = F.lower(_compact_license(F.coalesce(c, text(""))))
    return (
        F.when(known.startswith("cc0") | (known == "publicdomain"), "CC0")
        .when(known.startswith("cc-by-nc") | known.isin("cc-bync", "ccbync"), "CC-BY-NC")
        .when(known.startswith("cc-by") | known.isin("by", "ccby"), "CC-BY")
    )


def license_text(c: Column) -> Column:
    """The licence code as the text normaliser reads it: trimmed and lower-cased first."""
    known = _compact_license(F.lower(strip(c)))
    by = F.when(known.startswith("cc-by") | known.isin("by", "ccby"), "CC-BY").when(known == "ccbync", "CC-BY-NC")
    return F.when(known.startswith("cc0") | (known == "publicdomain"), "CC0").when(known.startswith("cc-by-nc"), "CC-BY-NC").otherwise(by)


def kingdom(c: Column) -> Column:
    """fungi or plants by what the text contains; fungi win."""
    low = F.lower(c)
    return F.when(low.contains("fung"), "fungi").when(low.contains("plant"), "plants")


def kingdom_of_taxon(taxon_id: Column, ancestry: Column, roots: Iterable[tuple[str, str]] = V.KINGDOM_ROOTS) -> Column:
    """The first root that the taxon is, or stands under by its slashed ancestry."""
    path = F.concat(text("/"), F.coalesce(ancestry, text("")), text("/"))
    found = F.lit(None).cast("string")
    for name, root in reversed(tuple(roots)):
        found = F.when(path.contains(f"/{root}/") | F.coalesce(taxon_id == root, F.lit(False)), name).otherwise(found)
    return found


def unknown_subclass(label: Column, kingdom_text: Column) -> Column:
    """unknown is told apart by kingdom; other labels stay."""
    known = kingdom(kingdom_text)
    return F.when(label.isNull() | (label != V.UNKNOWN), label).when(known == "plants", V.UNKNOWN_PLANT).when(known == "fungi", V.UNKNOWN_FUNGUS).otherwise(V.UNKNOWN_OTHER)


def collapse(label: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """The public label: mapped, or itself."""
    mapping = {k: V.UNKNOWN for k in V.INTERNAL_UNKNOWN} if mapping is None else mapping
    if not mapping:
        return label
    lookup = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, label), label)


def collapse_allowed(label: Column, allowed: Iterable[str], mapping: Mapping[str, str]) -> Column:
    """A label outside the allowed ones, whatever its case, is unknown; the others collapse."""
    low = F.lower(label)
    folded = {k.lower(): v for k, v in mapping.items()}
    inside = low.isin(*[x.lower() for x in allowed])
    mapped = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in folded.items() for x in pair]), low), label) if folded else label
    return F.when(inside, mapped).otherwise(V.UNKNOWN)


def is_known_target(label: Column) -> Column:
    return label != V.UNKNOWN


# --- regions ---------------------------------------------------------------------------------


def in_box(longitude: Column, latitude: Column, box: Mapping[str, tuple[float, float]]) -> Column:
    """Inclusive on all sides; null outside of numbers."""
    return longitude.between(*box["longitude"]) & latitude.between(*box["latitude"])


def in_priority_region(longitude: Column, latitude: Column) -> Column:
    return F.coalesce(in_box(longitude, latitude, V.PRIORITY_REGION), F.lit(False))


def in_any_box(longitude: Column, latitude: Column, boxes: Iterable[Mapping[str, tuple[float, float]]] = V.REGION_BOXES) -> Column:
    """Whether any of a few boxes holds the point; the boxes are an array, not a join."""
    cells = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("x0", "x1", "y0", "y1"), (*b["longitude"], *b["latitude"]), strict=True)]) for b in boxes])
    return F.exists(cells, lambda b: longitude.between(b["x0"], b["x1"]) & latitude.between(b["y0"], b["y1"]))


# --- casts of untyped metadata ---------------------------------------------------------------

_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?(nan|inf|infinity)\s*$"


def to_double(c: Column) -> Column:
    """A double, or null for what isn't a number (a type suffix isn't one)."""
    return F.when(F.lower(c).rlike(_NUMBER), c.try_cast("double"))


def to_whole(c: Column, kind: str = "int") -> Column:
    """A rounded whole number, or null if it isn't one or doesn't fit."""
    digits = c.rlike(r"^\s*[+-]?\d+\s*$")
    return F.when(digits, c.try_cast(kind)).otherwise(F.round(to_double(c)).try_cast(kind))


def int_or(c: Column, fallback: int, least: int = 1) -> Column:
    """The integer in a text, or the fallback if there is none or it is too small."""
    value = F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), c.try_cast("int"))
    return F.when(value >= least, value).otherwise(fallback)


def divide_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


# --- addresses and paths ---------------------------------------------------------------------


def _filled(pattern: str, **parts: Column) -> Column:
    """pattern with {names} replaced by columns; null if one is."""
    pieces, rest = [], pattern
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        pieces += [text(before), parts[name]]
    return F.concat(*pieces, text(rest))


def photo_url(photo_id: Column, extension: Column) -> Column:
    return _filled(V.PHOTO_URL, id=photo_id, ext=extension)


def photo_page(photo_id: Column) -> Column:
    return _filled(V.PHOTO_PAGE, id=photo_id)


def first_filled(first: Column, then: Column) -> Column:
    return F.coalesce(F.nullif(first, text("")), then)


def promote_size(url: Column) -> Column:
    """The large photo: the first size of the list that the address names gives way."""
    trimmed = strip(url)
    promoted = trimmed
    for size in reversed(V.PHOTO_SIZES):
        promoted = F.when(trimmed.contains(f"/{size}."), F.replace(trimmed, text(f"/{size}."), text("/large."))).otherwise(promoted)
    return promoted


def size_fallbacks(url: Column) -> Column:
    """Addresses to try in turn, each once."""
    tries = F.array_distinct(F.array(*[F.replace(url, text("/large."), text(f"/{s}.")) for s in V.FALLBACK_SIZES]))
    return F.when(url.contains("/large."), tries).otherwise(F.array(url))


def _slashed(path: Column) -> Column:
    return F.filter(F.split(F.replace(path, text("\\"), text("/")), "/"), lambda p: p != "")


def rebase_path(path: Column, root: str) -> Column:
    """What follows the first ``images``, else the first ``raw_cache``, else the last two parts, under root."""
    parts = _slashed(path)

    def after(name: str) -> Column:
        return F.slice(parts, F.array_position(parts, name).cast("int") + 1, F.greatest(F.size(parts), F.lit(1)))

    last_two = F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(2))
    kept = F.when(F.array_contains(parts, "images"), after("images")).when(F.array_contains(parts, "raw_cache"), after("raw_cache")).otherwise(last_two)
    kept = F.filter(kept, lambda p: p != ".")
    base = root.rstrip("/")
    return F.array_join(F.concat(F.array(text(base)), kept), "/") if base else F.array_join(kept, "/")


def portable_path(path: Column, prefix: str = "") -> Column:
    """images/<folder or misc>/<name>, under a prefix if there is one."""
    parts = F.split(F.replace(path, text("\\"), text("/")), "/")
    folder = F.coalesce(F.nullif(F.try_element_at(parts, F.lit(-2)), text("")), text("misc"))
    relative = F.concat_ws("/", text("images"), folder, F.element_at(parts, -1))
    base = prefix.rstrip("/\\").replace("\\", "/")
    return F.concat(text(base + "/"), relative) if prefix else relative


def planned_path(root: str, label: Column, photo_id: Column) -> Column:
    return F.concat(text(root.rstrip("/") + "/"), label, text("/"), photo_id, text(".jpg"))


def is_absolute(path: Column) -> Column:
    return path.rlike(r"^([/\\]|[A-Za-z]:)")


def resolve_path(path: Column, root: str) -> Column:
    return F.when(is_absolute(path), path).otherwise(F.concat(text(root.rstrip("/") + "/"), path))


def image_extension(url: Column) -> Column:
    """A known image ending of the address's path in lower case, or .jpg."""
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    found = F.lower(F.regexp_extract(path, r"(?i)(\.(?:jpg|jpeg|png|webp))$", 1))
    return F.coalesce(F.nullif(found, text("")), text(".jpg"))


def query_string(*pairs: tuple[str, Column]) -> Column:
    return F.concat_ws("&", *[F.concat(text(k + "="), F.replace(F.url_encode(v), text("+"), text("%20"))) for k, v in pairs])


def name_rank(name: Column, ranked: Iterable[str] = V.QUANTISATIONS, last: int = 100) -> Column:
    """Place of the first listed substring in a file name, or last."""
    low, rank = F.lower(name), F.lit(last)
    for i, part in reversed(list(enumerate(ranked))):
        rank = F.when(low.contains(part), i).otherwise(rank)
    return rank


def fix_rank(name: Column) -> Column:
    low = F.lower(name)
    return F.when(low.contains("fixed") | low.contains("mobile"), 0).otherwise(1)


# --- free text -------------------------------------------------------------------------------


def compact(c: Column) -> Column:
    """Runs of blanks, tabs and line ends become one blank; none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(c, text("")), r"[ \r\n\t]+", " "))


def shorten(c: Column, most: int = 520) -> Column:
    """compact(), with an ellipsis beyond a length."""
    whole = compact(c)
    return F.when(F.length(whole) > most, F.concat(F.substring(whole, 1, most - 3), text("..."))).otherwise(whole)


def short_description(description: Column, name: Column) -> Column:
    return F.when(compact(description) == "", _filled(V.NO_DESCRIPTION, name=name)).otherwise(shorten(description))


def ascii_only(c: Column) -> Column:
    """Bytes outside line ends, tabs and printable ASCII become one blank each."""
    # One Latin-1 character a byte, so that a class of characters is a class of bytes.
    by_byte = F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")
    return F.regexp_replace(by_byte, r"[^\n\r\t\x20-\x7E]", " ")


def label_mobile(c: Column) -> Column:
    """First label between the first and the last brace; quotes may be missing; unknown if none."""
    trimmed = strip(c)
    inside = F.regexp_extract(trimmed, r"(?s)(\{.*\})", 1)
    found = F.regexp_extract(inside, r'(?i)"?label_id"?\s*:\s*"?([A-Za-z0-9_]+)"?', 1)
    return F.coalesce(F.nullif(found, text("")), text(V.UNKNOWN))


def _last_quoted(c: Column) -> Column:
    return strip(F.try_element_at(F.regexp_extract_all(c, F.lit(r'(?i)"label_id"\s*:\s*"([^"]+)"'), F.lit(1)), F.lit(-1)))


def label_desktop(out: Column, error: Column) -> Column:
    """Last quoted label of the output from its first brace on, of the output, of the error text; else unknown."""
    likely = F.when(F.locate("{", out) > 0, F.substring(out, F.locate("{", out), F.length(out))).otherwise(out)
    return F.coalesce(_last_quoted(likely), _last_quoted(out), _last_quoted(error), text(V.UNKNOWN))


def label_prefixed(c: Column, prefix: str = '{"label_id":"') -> Column:
    """The first run of word characters after a literal start; empty if the start or the run is missing."""
    return F.when(F.substring(c, 1, len(prefix)) == prefix, F.regexp_extract(F.substring(c, len(prefix) + 1, 2**31 - 1), r"^[^A-Za-z0-9_]*([A-Za-z0-9_]+)", 1)).otherwise("")


def label_valid(c: Column) -> Column:
    """unknown, or a plant or fungus from 01 to 20."""
    return c.rlike(r"^(unknown|(PLANT|FUN)_(0[1-9]|1[0-9]|20))\z")


def normal_output(c: Column, forced_prefix: bool = True) -> Column:
    """Canonical JSON of a model's output; what is empty or not supported is unknown."""
    clean = ascii_only(c)
    label = label_prefixed(clean)
    kept = F.when(label_valid(label), F.concat(text('{"label_id":"'), label, text('"}'))) if forced_prefix else clean
    return F.when(F.length(c) > 0, F.coalesce(kept, text('{"label_id":"unknown"}'))).otherwise('{"label_id":"unknown"}')


def assistant_label(messages: Column) -> Column:
    """label_id in the first assistant message's JSON content."""
    said = F.filter(messages, lambda m: F.lower(m["role"]) == "assistant")
    return F.get_json_object(F.try_element_at(said, F.lit(1))["content"], "$.label_id")


def json_text(c: Column) -> Column:
    """A JSON string literal with non-ASCII kept; null for null."""
    # to_json leaves the slash and non-ASCII alone, as the format wants it.
    return F.when(c.isNotNull(), F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1))


def json_object(*pairs: tuple[str, Column]) -> Column:
    """A JSON object of strings with ", " and ": " between."""
    fields = [F.concat(text(f'"{k}": '), F.coalesce(json_text(v), text("null"))) for k, v in pairs]
    return F.concat(text("{"), F.concat_ws(", ", *fields), text("}"))


def without_blanks(array: Column) -> Column:
    return F.filter(array, lambda x: F.trim(x) != "")


def content_hash(c: Column) -> Column:
    return F.upper(F.sha2(c, 256))


def coordinate(c: Column) -> Column:
    return F.format_string("%.6f", c)


def flag_text(c: Column) -> Column:
    return F.lower(c.cast("string"))


def fill_marker(prompt: Column, marker: Column, placeholder: str = "<image>") -> Column:
    return F.replace(prompt, text(placeholder), marker)


def summary_line(passed: Column, warned: Column, failed: Column) -> Column:
    return F.format_string("%d PASS / %d WARN / %d FAIL", passed, warned, failed)


def rolling_hash(values: Column, start: Column) -> Column:
    """acc * 31 + value over an array of whole numbers, in 32 bits that wrap around; signed."""
    low = lambda x: x.bitwiseAND(F.lit((1 << 32) - 1))
    folded = F.aggregate(values, low(start.cast("long")), lambda acc, v: low(acc * 31 + v.cast("long")))
    return F.when(folded >= 1 << 31, folded - (1 << 32)).otherwise(folded).cast("int")


def grid_hash(cells: Column, width: Column, height: Column, steps: int = 6) -> Column:
    """rolling_hash of a row-major grid's cells, about steps of each row and column, after its sides."""
    def places(side: Column) -> Column:
        return F.sequence(F.lit(0), side - 1, F.greatest(F.floor(side / steps), F.lit(1)).cast("int"))

    sampled = F.flatten(F.transform(places(height), lambda y: F.transform(places(width), lambda x: F.get(cells, y * width + x))))
    return rolling_hash(F.when((width > 0) & (height > 0), sampled).otherwise(F.array().cast("array<int>")), width.cast("long") * 31 + height)


def mock_label(signature: Column, labels: list[str]) -> Column:
    """What the classifier's stand-in answers: unknown for multiples of 7, else a label by the signature's size; the last label is the unknown one."""
    place = F.abs(signature.cast("long")) % (len(labels) - 1)
    return F.when(signature % 7 == 0, V.UNKNOWN).otherwise(F.element_at(F.array(*map(F.lit, labels)), (place + 1).cast("int")))
