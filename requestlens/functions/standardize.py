"""Column expressions that bring codes, names and addresses to one spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from requestlens import fixed_values as V


def upper_trim(value: Column) -> Column:
    return F.upper(F.trim(value))


def strip(value: Column) -> Column:
    """Trim every kind of ASCII white space, not only blanks."""
    return F.trim(value, F.lit(" \t\n\r\x0b\x0c"))


def lookup(value: Column, mapping: dict[str, str]) -> Column:
    """Value of a literal map; null when the key is absent."""
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), value)


def borough(value: Column, any_space: bool = False) -> Column:
    """One of five names, else UNSPECIFIED; ``any_space`` also trims tabs and line ends."""
    names = {alias: name for name, aliases in V.BOROUGH_ALIASES.items() for alias in aliases}
    text = F.upper(strip(value)) if any_space else upper_trim(value)
    return F.coalesce(lookup(text, names), F.lit(V.UNSPECIFIED))


def agency(value: Column) -> Column:
    """Long agency names to codes; other text passes through in upper case, empty text is null."""
    text = F.upper(strip(F.nullif(value, F.lit(""))))
    return F.coalesce(lookup(text, V.AGENCY_ALIASES), text)


def zip_code(value: Column) -> Column:
    """The five leading digits when they lie in the city's range."""
    digits = F.nullif(F.regexp_extract(strip(value), "^([0-9]{5})", 1), F.lit(""))
    return F.when(digits.cast("int").between(V.ZIP_LOW, V.ZIP_HIGH), digits)


def zip_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def address_parts(address: Column) -> Column:
    """Struct of house number, street name, street type and unit; all null when the text has another shape."""
    # One match per text: its groups are joined by a control character, which no address holds, and split again.
    marked = F.regexp_replace(F.translate(F.upper(address), "\x01", ""), V.ADDRESS_PATTERN, "$1\x01$2\x01$3\x01$4\x01$5")

    def named(parts: Column) -> Column:
        def group(number: int) -> Column:
            return F.when(F.size(parts) == 5, F.nullif(parts[number], F.lit("")))

        return F.struct(
            group(0).alias("house_number"),
            F.trim(group(1)).alias("street_name"),
            group(2).alias("street_type"),
            F.when(group(3).isNotNull(), F.concat_ws(" ", group(3), group(4))).alias("unit"),
        )

    return F.transform(F.array(F.split(marked, "\x01", -1)), named)[0]


def location(value: Column) -> Column:
    """Struct of type, coordinates and human_address from a JSON object; nulls for anything else."""
    parsed = F.from_json(value, "type string, coordinates array<string>, human_address string")
    return F.struct(
        parsed["type"].alias("type"),
        F.transform(parsed["coordinates"], lambda part: part.try_cast("double")).alias("coordinates"),
        parsed["human_address"].alias("human_address"),
    )


def agency_domain(code: Column) -> Column:
    domains = {member: domain for domain, members in V.AGENCY_DOMAINS.items() for member in members}
    return F.coalesce(lookup(code, domains), F.lit(V.OTHER_DOMAIN))


def county(name: Column) -> Column:
    return F.coalesce(lookup(name, V.BOROUGH_COUNTY), F.lit("Unspecified"))


def borough_order(name: Column) -> Column:
    order = F.array(*[F.lit(item) for item in V.BOROUGH_ORDER])
    return F.coalesce(F.array_position(order, name), F.lit(0)).cast("int")
