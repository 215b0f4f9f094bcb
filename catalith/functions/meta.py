"""JSON metadata kept as maps, and the texts that are made from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keys that hold what the content says; all others hold what the file is.
CONTENT_KEYS = ("summary", "keywords", "labels", "objects", "keyframes", "stt", "caption", "title_match", "title_only")
ABOUT_MOST, ABOUT_CHARS, PATH_PATTERN, ID_PATTERN = 3, 200, r"[^/]+$", r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def file_facts(meta: Column) -> Column:
    return F.map_filter(meta, lambda k, _: ~k.isin(*CONTENT_KEYS))


def content_signals(meta: Column) -> Column:
    return F.map_filter(meta, lambda k, _: k.isin(*CONTENT_KEYS))


def merged(old: Column, new: Column, removed: list[str] | None = None) -> Column:
    """old with new's keys over its own and without the removed ones; an empty value is stored like any other."""
    old, new = F.coalesce(old, F.create_map().cast("map<string,string>")), F.coalesce(new, F.create_map().cast("map<string,string>"))
    both = F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)
    return F.map_filter(both, lambda k, _: ~k.isin(*removed)) if removed else both


def key_missing(meta: Column, key: str) -> Column:
    """Never tried: a key with an empty value was tried."""
    return ~F.coalesce(F.map_contains_key(meta, key), F.lit(False))


def array_length(json: Column) -> Column:
    """Length of a JSON array; null for any other value."""
    return F.when(F.trim(json).startswith("["), F.json_array_length(json))


def whole_number(text: Column, default: int = -1) -> Column:
    """A whole number, or default for anything else."""
    return F.coalesce(F.when(text.rlike(r"^\d+$"), text.try_cast("int")), F.lit(default))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, PATH_PATTERN, 0)


def under(path: Column, root: str) -> Column:
    """Below root, at a separator; root itself isn't."""
    return path.startswith(root.rstrip("/") + "/")


def malformed(id_: Column) -> Column:
    return ~F.coalesce(F.lower(id_).rlike(ID_PATTERN), F.lit(False))


def confirmed_title(title: Column, match: Column) -> Column:
    return F.when(match == "yes", F.nullif(F.trim(title), F.lit("")))


def name_hint(name: Column, match: Column) -> Column:
    """A file name says nothing where the title was judged not to fit."""
    return F.when(F.coalesce(match, F.lit("")) != "no", name)


def best_labels(labels: Column, least: float, most: int) -> Column:
    """Of structs with a score, those from least on, in their order, at most so many."""
    return F.slice(F.filter(labels, lambda x: x["score"] >= least), 1, most)


def _line(values: Column) -> Column:
    return F.array_join(F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""), " ")


def self_text(summary: Column, keywords: Column, labels: Column) -> Column:
    """Summary, keywords, labels (arrays of strings) in this order; empty if all are."""
    blank = lambda x: F.nullif(x, F.lit(""))
    return F.concat_ws(" ", blank(F.trim(summary)), blank(_line(keywords)), blank(_line(labels)))


def with_title(text: Column, title: Column, label: str = "제목: ") -> Column:
    """A title line before a text; as it is when either is blank."""
    return F.when((F.trim(F.coalesce(title, F.lit(""))) != "") & (F.trim(text) != ""), F.concat(F.lit(label), title, F.lit("\n"), text)).otherwise(text)


def embedding_text(summary: Column, keywords: Column, labels: Column) -> Column:
    """A line each; one space if there is nothing."""
    blank = lambda x: F.nullif(x, F.lit(""))
    text = F.concat_ws("\n", blank(F.trim(summary)), blank(_line(keywords)), blank(_line(labels)))
    return F.when(text == "", " ").otherwise(text)


def about(json: Column) -> Column:
    """The first three entries of a JSON list, trimmed, without blank ones; none of anything else."""
    listed = F.from_json(json, "array<string>")
    return F.slice(F.filter(F.transform(F.coalesce(listed, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""), 1, ABOUT_MOST)


def composite_version(*parts: Column) -> Column:
    return F.concat_ws("+", *parts)


def material(name: Column, kind: Column, description: Column, summaries: Column) -> Column:
    """What an entity is judged by; null where its name or kind is blank."""
    lines = F.concat_ws("\n", name, kind, F.nullif(F.trim(description), F.lit("")), F.nullif(F.array_join(F.slice(F.coalesce(summaries, F.array().cast("array<string>")), 1, 3), "\n"), F.lit("")))
    return F.when((F.trim(F.coalesce(name, F.lit(""))) != "") & (F.trim(F.coalesce(kind, F.lit(""))) != ""), lines)


def search_material(name: Column, kind: Column, description: Column, keywords: Column, member_keywords: Column) -> Column:
    blank = lambda x: F.nullif(x, F.lit(""))
    return F.concat_ws("\n", name, kind, blank(F.trim(description)), blank(_line(keywords)), blank(_line(member_keywords)))


def drift(hash_: Column, old_hash: Column, known: Column, version: Column, old_version: Column, prompt: Column, old_prompt: Column) -> Column:
    """Why a judged pair is due again: new, hash_null, mixed (two things changed at least), hash_changed, skill_version,
    prompt_version; null where nothing changed. mixed goes before the single reasons, hash_null before mixed."""
    changed = [F.coalesce(hash_ != old_hash, F.lit(False)), F.coalesce(version != old_version, F.lit(True)), F.coalesce(prompt != old_prompt, F.lit(True))]
    n = sum((c.cast("int") for c in changed[1:]), changed[0].cast("int"))
    return F.when(~known, "new").when(old_hash.isNull(), "hash_null").when(n > 1, "mixed").when(changed[0], "hash_changed").when(changed[1], "skill_version").when(changed[2], "prompt_version")


def nfc(text: Column) -> Column:
    """Unicode's composed form; Spark has no function of its own for it."""

    @F.pandas_udf("string")
    def composed(values):
        return values.str.normalize("NFC")

    return composed(text)
