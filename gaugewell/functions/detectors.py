"""Detectors: does a cell look like a zip code, a street, a colour ...?

A detector is a name and a condition over the cell as written and the cell in
lower case, in SQL or as a Column.  Word searches are ``contains`` on bytes (about
2.5 times as fast as the alternation they stand for), lists are hash lookups, and
each regular expression sits behind a cheap test that any match must pass.  NULL
is never a hit.

A detector by a table of names has no condition: cells are joined with the table,
however long it is (see ``semantic.detector_counts``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugewell.functions import vocab

# (cell, lower-cased cell), as SQL -> boolean SQL, or a Column
Condition = Callable[[str, str], "str | Column"]


@dataclass(frozen=True)
class Detector:
    """A condition, or ``names``: a table whose first column lists the cells meant, in lower case or not."""

    name: str
    condition: Condition | None = None
    names: DataFrame | None = None

    def hits(self, cell: str = "value", lowered: str | None = None) -> Column:
        if self.condition is None:
            raise ValueError(f"{self.name} is a table of names: cells are joined with it")
        test = self.condition(cell, lowered or f"lower({cell})")
        return F.expr(test) if isinstance(test, str) else test


# Patterns of the detectors.
ZIP_CODE = r"^(1(0|1)\d{3})$"
PHONE_NUMBER = r"^\s*(?:\+?(\d{1,3}))?[-. (]*(\d{3})[-. )]*(\d{3})[-. ]*(\d{4})(?: *x(\d+))?\s*$"
LATITUDE = r"^40[.]\d+$"
LONGITUDE = r"^[-]7(3|4)[.]\d+$"
LAT_LON_CORD = r"^[(]40[.]\d+[,\s]{1,2}[-]7(3|4)[.]\d+[)]$"
BOROUGH = r"^(manhattan|brooklyn|queens|bronx|staten island)$"
WEBSITE = (
    r"^https?:\/\/(?:www\.|(?!www))[a-zA-Z0-9][a-zA-Z0-9-]+[a-zA-Z0-9]\.[^\s]{2,}"
    r"|www\.[a-zA-Z0-9][a-zA-Z0-9-]+[a-zA-Z0-9]\.[^\s]{2,}"
    r"|https?:\/\/(?:www\.|(?!www))[a-zA-Z0-9]+\.[^\s]{2,}"
    r"|www\.[a-zA-Z0-9]+\.[^\s]{2,}$"
)
BUILDING_CLASSIFICATION = r"^[A-Z][0-9A-Z][-][-\w]+$"
MIDDLE_INITIAL = r"^[A-Z][.]?$"

# House number, words parted by single blanks, street suffix.  Double blanks are
# turned into line ends first, so that one character class can span the words:
# matching is then linear per house number and needs no recursion, whatever the
# length of the text.
ADDRESS = r"\d+ [a-z0-9.-][a-z0-9. -]*(?:ave|dr|rd|blvd|ln|st|av)"


def _quoted(text: str) -> str:
    """A SQL literal; text with quotes or backslashes depends on the session's settings and is no such literal."""
    if "'" in text or "\\" in text:
        raise ValueError(text)
    return f"'{text}'"


def _matches(cell: str, pattern: str) -> Column:
    return F.expr(cell).rlike(pattern)


def _words(words: Iterable[str]) -> Condition:
    # A word that contains another of the list adds nothing to the search.
    words = list(words)
    least = [w for w in words if not any(o != w and o in w for o in words)]
    return lambda cell, low: "(" + " OR ".join(f"contains({low}, {_quoted(w)})" for w in least) + ")"


def _listed(names: Iterable[str], lower: bool) -> Condition:
    names = list(names)
    if not names:
        return lambda cell, low: "false"
    if any("'" in n or "\\" in n for n in names):
        return lambda cell, low: F.expr(low if lower else cell).isin(names)
    listed = ", ".join(_quoted(n) for n in names)
    return lambda cell, low: f"{low if lower else cell} IN ({listed})"


def _no_longer(cell: str, n: int) -> Column:
    """Length test before an anchored pattern; ``$`` may precede a line end."""
    return F.expr(f"length({cell}) <= {n + 2}")


def _starts(cell: str, lead: str) -> Column:
    return F.expr(cell).startswith(lead)


def _address(cell: str, low: str) -> Column:
    return F.replace(F.expr(low), F.lit("  "), F.lit("\n")).rlike(ADDRESS)


def _named(name: str, names: Iterable[str] | DataFrame) -> Detector:
    """Membership of the lower-cased cell in a list, or in the first column of a table.

    A list of more than ``vocab.MAX_NAMES`` entries becomes a table, as lists are literals
    of the plan.
    """
    if isinstance(names, DataFrame):
        return Detector(name, names=names)
    names = tuple(names)
    if len(names) <= vocab.MAX_NAMES:
        return Detector(name, _listed(names, lower=True))
    spark = SparkSession.getActiveSession()
    return Detector(name, names=spark.createDataFrame([(n,) for n in names], "name string"))


def detectors(
    neighbourhoods: Iterable[str] | DataFrame | None = None,
    fix_vocab: bool = False,
    opt_in: bool = False,
) -> list[Detector]:
    """The detectors in output order.

    ``neighbourhoods``: names in a list, or a table with the names in its first
    column; without them that detector is left out.  ``fix_vocab`` adds the corrected list entries.  ``opt_in`` appends
    latitude, longitude and address, which are off by default.
    """
    areas, places = vocab.AREAS_OF_STUDY, vocab.LOCATION_TYPES
    if fix_vocab:
        areas, places = areas + vocab.FIXED_AREAS_OF_STUDY, places + vocab.FIXED_LOCATION_TYPES
    longest_borough = len("staten island")
    found = [
        Detector("zip_code", lambda c, low: _starts(low, "1") & _matches(low, ZIP_CODE)),
        Detector("phone_number", lambda c, low: _matches(low, PHONE_NUMBER)),
        Detector("school_name", _words(vocab.SCHOOL_NAME_WORDS)),
        Detector("street_name", _words(vocab.STREET_NAME_WORDS)),
        Detector("lat_lon_cord", lambda c, low: _starts(low, "(40.") & _matches(low, LAT_LON_CORD)),
        Detector("college_name", _words(vocab.COLLEGE_NAME_WORDS)),
        Detector("borough", lambda c, low: _no_longer(low, longest_borough) & _matches(low, BOROUGH)),
        Detector("park_playground", _words(vocab.PARK_WORDS)),
        Detector("website", lambda c, low: F.expr(_words(("www.", "://"))(c, low)) & _matches(low, WEBSITE)),
        Detector("business_name", _words(vocab.BUSINESS_NAME_WORDS)),
        Detector("subject_in_school", _listed(vocab.SUBJECTS, lower=True)),
    ]
    if neighbourhoods is not None:
        found.append(_named("neighbourhood", neighbourhoods))
    found += [
        Detector("city_agency", _words(vocab.CITY_AGENCY_WORDS)),
        Detector("school_level", _words(vocab.SCHOOL_LEVEL_WORDS)),
        Detector(
            "building_classification",
            lambda c, low: F.expr(f"substring({c}, 3, 1) = '-'") & _matches(c, BUILDING_CLASSIFICATION),
        ),
        Detector("area_of_study", _listed(areas, lower=True)),
        Detector("MiddleInitial", lambda c, low: _no_longer(c, 2) & _matches(c, MIDDLE_INITIAL)),
        Detector("car_make", _listed(vocab.CAR_MAKES, lower=False)),
        Detector("location_type", _listed(places, lower=False)),
        Detector("color", _listed(vocab.COLORS, lower=False)),
    ]
    if opt_in:
        found += [
            Detector("Latitude", lambda c, low: _starts(low, "40.") & _matches(low, LATITUDE)),
            Detector("Longitude", lambda c, low: _starts(low, "-7") & _matches(low, LONGITUDE)),
            Detector("address", _address),
        ]
    return found


# Column-name tokens (lower case, split at "_") and the type they mean.
NAME_RULES = (
    ("person_name", ("last", "name")),
    ("person_name", ("first", "name")),
    ("vehicle_body_type", ("vehicle", "body", "type")),
    ("vehicle_type_code", ("vehicle", "type", "code")),
)


def named_types(column_name: Column) -> Column:
    """Array of the semantic types a column's name implies."""
    tokens = F.split(F.lower(column_name), "_")

    def all_in(words: tuple[str, ...]) -> Column:
        return F.size(F.array_except(F.array(*[F.lit(w) for w in words]), tokens)) == 0

    return F.array_distinct(
        F.array_compact(F.array(*[F.when(all_in(words), F.lit(kind)) for kind, words in NAME_RULES]))
    )
