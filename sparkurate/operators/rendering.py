"""Prompts, answers and chat examples. Catalogs are given as rows in order; text is made once on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkurate import schemas
from sparkurate.functions import columns as C
from sparkurate.functions import values as V

#: Who is asked how: the parts of each prompt, in order, and what stands between them. A pair is
#: the text without and with internal unknowns in the catalog; LINES are the catalog's entries.
LINES, LAST = object(), object()
PROMPTS = {
    "legacy_full_json": ("", (V.LEGACY_SYSTEM,), (V.LEGACY_USER,)),
    "strict_label_only": (" ", (V.CLASSIFY, V.JSON_ONLY, V.OUTPUTS, V.NO_INVENTION), (V.USER, V.USER_FALLBACK)),
    "strict_label_only_with_taxonomy": ("\n", (V.CLASSIFY, V.JSON_ONLY, V.CHOOSE, V.FALLBACK, V.NO_INVENTION, "Allowed labels:", LINES, LAST), (V.USER, V.USER_FALLBACK)),
    "desktop": ("\n", (V.CLASSIFY, V.JSON_ONLY, V.CHOOSE, V.FALLBACK[True], V.NO_THINKING, V.NO_INVENTION, "Allowed labels:", LINES), ()),
}
STYLES = tuple(PROMPTS)[:3]
#: The ablation's variants are the prompt styles; only the first answers in full.
ABLATION = {s: (s, "label_only" if i else "full_json") for i, s in enumerate(STYLES)}


def catalog_rows(manifest: Sequence[Sequence[str]], internal: bool = False) -> list[tuple[str, ...]]:
    """The manifest's entries, unknown, and for training the internal unknowns."""
    return [tuple(m[:5]) for m in manifest] + [V.UNKNOWN_ENTRY] + (list(V.INTERNAL_ENTRIES) if internal else [])


def render(style: str, turn: int, catalog: Sequence[Sequence[str]]) -> str:
    """A style's system (1) or user (2) prompt for a catalog."""
    if style not in PROMPTS:
        raise ValueError(f"no prompt style {style!r}")
    notes = {e[0]: (e[4], V.INTERNAL_NOTE) for e in catalog if e[0] in V.INTERNAL_UNKNOWN}
    texts = []
    for part in PROMPTS[style][turn]:
        if part is LINES:
            texts += ["- {} = {}{}".format(e[0], *notes.get(e[0], (e[2], ""))) for e in catalog if e[0] != V.UNKNOWN]
        else:
            choice = V.LAST_LINE if part is LAST else part
            texts.append(choice[bool(notes)] if isinstance(choice, dict) else choice)
    return ("" if turn == 2 else PROMPTS[style][0]).join(texts)


def system_prompt(style: str, catalog: Sequence[Sequence[str]]) -> str:
    return render(style, 1, catalog)


def user_prompt(style: str, catalog: Sequence[Sequence[str]]) -> str:
    return render(style, 2, catalog)


def mobile_prompt(labels: Sequence[str]) -> str:
    return f"{V.MOBILE_SYSTEM}{','.join(labels)}."


def mobile_taxonomy(catalog: Sequence[Sequence[str]]) -> str:
    return "\n".join([f"{e[0]}: {e[2]} ({e[3]}; {e[4]})" for e in catalog if e[0] != V.UNKNOWN] + [V.UNKNOWN_TAXON_LINE])


def answer(style: str, label: Column, kingdom: Column, scientific: Column, polish: Column) -> Column:
    """The assistant's JSON: the label alone, or with kingdom and names."""
    if style == "label_only":
        return C.json_object(("label_id", label))
    if style != "full_json":
        raise ValueError(f"no answer style {style!r}")
    return C.json_object(("label_id", label), ("kingdom", kingdom), ("scientific_name", scientific), ("polish_name", polish))


def with_entry(rows: DataFrame, catalog: Sequence[Sequence[str]], collapse: bool = False) -> DataFrame:
    """rows with _label and the catalog's _kingdom, _scientific, _polish; a label outside is an error."""
    label = C.collapse(F.col("label_id")) if collapse else F.col("label_id")
    field = F.create_map(*[x for e in catalog for x in (F.lit(e[0]), F.struct(F.lit(e[1]).alias("kingdom"), F.lit(e[2]).alias("scientific"), F.lit(e[3]).alias("polish")))])
    entry = F.coalesce(F.try_element_at(field, F.col("_label")), F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(F.col("_label"), F.lit("null")))))
    return rows.withColumn("_label", label).withColumn("_entry", entry).select("*", *[F.col(f"_entry.{k}").alias(f"_{k}") for k in ("kingdom", "scientific", "polish")]).drop("_entry")


def chat(system: Column, user: Column, said: Column) -> Column:
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("system", system), turn("user", user), turn("assistant", said))


def examples(rows: DataFrame, catalog: Sequence[Sequence[str]], prompt_style: str = "legacy_full_json", answer_style: str = "full_json", collapse: bool = False, files: DataFrame | None = None) -> DataFrame:
    """messages, images of every row (label_id, image_path); with files, a missing image is an error."""
    if files is not None:
        absent = rows.select(F.col("image_path").alias("path")).join(files.select("path"), "path", "left_anti").limit(1).collect()
        if absent:
            raise FileNotFoundError(absent[0]["path"])
    found = with_entry(rows, catalog, collapse)
    said = answer(answer_style, *[F.col(k) for k in ("_label", "_kingdom", "_scientific", "_polish")])
    prompts = (F.lit(system_prompt(prompt_style, catalog)), F.lit(user_prompt(prompt_style, catalog)))
    return found.select(chat(*prompts, said).alias("messages"), F.array("image_path").alias("images"))


def ablation(rows: DataFrame, manifest: Sequence[Sequence[str]], internal: bool = False) -> DataFrame:
    """variant, messages, images: the rows in every prompt variant; internal unknowns collapse unless asked for."""
    catalog = catalog_rows(manifest, internal)
    parts = [examples(rows, catalog, prompt, said, collapse=not internal).select(F.lit(name).alias("variant"), "messages", "images") for name, (prompt, said) in ABLATION.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def manifest_list(manifest: DataFrame) -> list[tuple[str, ...]]:
    """A manifest's rows in order; it has some tens."""
    return [tuple(r) for r in manifest.orderBy("place").select(*schemas.MANIFEST.names).limit(1000).collect()]
