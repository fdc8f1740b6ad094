"""Column functions over element paths, names, versions and values. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from filing_jobs.functions.tables import FORM_TITLES, LABEL_WORDS, NAME_WORDS, OLDER_NAMES, TYPE_NAMES


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def _number(version: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(version, pattern, group).try_cast("int")


def version_key(version: Column) -> Column:
    """FN-1. (year, major, minor) of the dictionary's order; parts may be missing, (0, 0, 0) if there is no year."""
    parts = [F.coalesce(_number(version, r"^(\d{4})v?(\d+)?\.?(\d+)?", g), F.lit(0)) for g in (1, 2, 3)]
    return F.struct(*(p.alias(n) for p, n in zip(parts, ("year", "major", "minor"), strict=True)))


def filing_version_key(version: Column) -> Column:
    """FN-2. (year, 10 * major + minor) of the extraction's order; (0, 0) unless all parts are there."""
    pattern = r"^(\d{4})v(\d+)\.(\d+)"
    year, major, minor = (_number(version, pattern, g) for g in (1, 2, 3))
    return F.struct(F.coalesce(year, F.lit(0)).alias("year"), F.coalesce(major * 10 + minor, F.lit(0)).alias("part"))


def segments(xpath: Column) -> Column:
    """The path's element names."""
    return F.split(F.regexp_replace(xpath, "^/+|/+$", ""), "/")


def joined(parts: Column, start: Column | int, size: Column, mark: str = "/") -> Column:
    return F.array_join(F.slice(parts, start, F.greatest(size, F.lit(0))), mark)


def canonical_name(xpath: Column) -> Column:
    """FN-3. The names below the form, joined by underscores; a path of one name is that name."""
    parts = segments(xpath)
    return F.when(F.size(parts) > 1, joined(parts, 2, F.size(parts) - 1, "_")).otherwise(parts[0])


def spaced(name: Column) -> Column:
    """A blank where a capital follows a small letter."""
    return F.regexp_replace(name, "(?<=[a-z])(?=[A-Z])", " ")


def label(name: Column) -> Column:
    """FN-4. The readable label: spaced, then the replacements one after the other."""
    return F.trim(reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), LABEL_WORDS, spaced(name)))


def inferred_description(xpath: Column, name: Column) -> Column:
    """FN-5. What stands in for a missing description."""
    parts = segments(xpath)
    return F.when(F.size(parts) > 1, F.format_string("%s (within %s)", spaced(F.element_at(parts, -1)), spaced(F.get(parts, F.size(parts) - 2)))).otherwise(name)


def type_name(raw: Column) -> Column:
    """FN-6. Description of a schema type; unknown types stay."""
    return F.coalesce(literal_map(TYPE_NAMES)[raw], raw)


def without_prefix(name: Column) -> Column:
    """FN-7. Without the namespace prefix: all up to the first colon goes."""
    return F.regexp_replace(name, "^[^:]*:", "")


def group_of(xpath: Column) -> Column:
    """FN-8. struct(name, prefix, relative) of the deepest enclosing repeating group, empty if there is none.

    A group is a name that ends in Grp, Detail or Table and is neither the first nor the last of the path.
    """
    parts = F.split(F.ltrim(xpath, F.lit("/")), "/")
    places = F.filter(F.sequence(F.lit(2), F.greatest(F.size(parts) - 1, F.lit(2))), lambda k: (k < F.size(parts)) & F.get(parts, k - 1).rlike("(Grp|Detail|Table)$"))
    at = F.when(xpath.startswith("/"), F.array_max(places))
    return F.struct(
        F.coalesce(F.get(parts, at - 1), F.lit("")).alias("name"),
        F.when(at.isNotNull(), F.concat(F.lit("/"), joined(parts, 1, at))).otherwise("").alias("prefix"),
        F.when(at.isNotNull(), joined(parts, F.coalesce(at, F.lit(1)) + 1, F.size(parts) - at)).otherwise("").alias("relative"),
    )


def schedule_of(xpath: Column) -> Column:
    """FN-9. The first name of a path."""
    return segments(xpath)[0]


def leaf_of(xpath: Column) -> Column:
    """FN-9. The last name of a path."""
    return F.element_at(segments(xpath), -1)


def parent_of(xpath: Column) -> Column:
    """FN-9. The path above; empty for a path of one name."""
    parts = segments(xpath)
    return F.when(F.size(parts) > 1, F.concat(F.lit("/"), joined(parts, 1, F.size(parts) - 1))).otherwise("")


def guessed_type(sample: Column) -> Column:
    """FN-10. The type that a sample value looks like."""
    v = F.trim(sample)
    return (
        F.when(F.coalesce(sample, F.lit("")) == "", "unknown")
        .when(F.lower(v).isin("true", "false", "0", "1", "x"), "boolean")
        .when(v.rlike(r"(?U)^-?\d+$"), "integer")
        .when(v.rlike(r"(?U)^-?\d+\.\d+$"), "decimal")
        .when(v.rlike(r"(?U)^\d{4}-\d{2}-\d{2}"), "date")
        .when(v.rlike(r"(?U)^\d{2}-\d{7}$"), "EIN")
        .when(F.length(v) > 50, "text_long")
        .otherwise("text")
    )


def nontrivial(value: Column) -> Column:
    """FN-11. Whether a value says something."""
    return ~F.upper(F.trim(F.coalesce(value, F.lit("")))).isin("", "0", "0.00", "NONE", "N/A")


def plain_words(name: Column) -> Column:
    """FN-12. The name's words in lower case, abbreviations written out, joined by blanks."""
    words = F.regexp_extract_all(name, F.lit("[A-Z][a-z]*|[a-z]+"), F.lit(0))
    table = literal_map(NAME_WORDS)
    return F.when(F.size(words) > 0, F.array_join(F.transform(words, lambda w: F.coalesce(table[F.lower(w)], F.lower(w))), " ")).otherwise(F.lower(name))


def bigrams(name: Column) -> Column:
    """The distinct pairs of neighbouring characters, in lower case."""
    low = F.lower(name)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - 1, F.lit(1))), lambda k: F.substring(low, k, F.lit(2)))
    return F.when(F.length(low) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def dice(a: Column, b: Column) -> Column:
    """FN-13. Similarity of two names by their pairs of characters; 0 if one has none."""
    x, y = bigrams(a), bigrams(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y)))


def part_score(a: Column, b: Column, same_schedule: Column) -> Column:
    """FN-14. Score of names of which one holds the other, or whose last eight characters are equal."""
    x, y = F.lower(a), F.lower(b)
    holds = (F.length(x) > 5) & (F.length(y) > 5) & (x.contains(y) | y.contains(x))
    ends = (F.length(x) > 8) & (F.length(y) > 8) & (F.right(x, F.lit(8)) == F.right(y, F.lit(8)))
    return F.when(holds, F.when(same_schedule, 0.75).otherwise(0.55)).when(ends, F.when(same_schedule, 0.6).otherwise(0.45)).otherwise(0.0)


def confidence(score: Column) -> Column:
    """FN-15. Band of a rename's score."""
    return F.when(score >= 0.8, "HIGH").when(score >= 0.6, "MED").otherwise("LOW")


def rename_status(match: Column, score: Column) -> Column:
    """FN-15. What a proposed addition is: a rename by its score, or new."""
    found = F.coalesce(match, F.lit("")) != ""
    return F.when(found & (score >= 0.8), "PROBABLE_RENAME").when(found & (score >= 0.6), "POSSIBLE_RENAME").otherwise("NEEDS_REVIEW")


def frequency_band(percent: Column) -> Column:
    """FN-16. Colour of a field's frequency."""
    return F.when(percent.isNull(), "N/A").when(percent >= 50, "green").when(percent >= 10, "orange").otherwise("red")


def form_title(name: Column) -> Column:
    """FN-17. Title of a form; unknown names stay."""
    return F.coalesce(literal_map(FORM_TITLES)[name], name)


def older_name(leaf: Column) -> Column:
    """What older filings call an element, or null."""
    return literal_map(OLDER_NAMES)[leaf]
