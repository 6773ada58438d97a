"""Column-name normalisation (metadata only; runs on the driver) and names of
versioned entries (column expressions)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed replacements applied before case conversion, as the public
# documentation of the R name cleaner describes them.
NAME_REPLACEMENTS = {"'": "", '"': "", "%": "_percent_", "#": "_number_"}

# Letters that do not decompose into a Latin letter and a mark.
LETTERS = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Þ": "TH", "þ": "th",
    "Ł": "L", "ł": "l", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "q", "Ŋ": "N", "ŋ": "n", "ß": "ss", "ẞ": "SS", "Ŧ": "T", "ŧ": "t",
    "µ": "u", "°": "deg", "×": "x",
}
GREEK = (
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma_final sigma tau upsilon "
    "phi chi psi omega"
).split()
#: Greek letters by their names, in the order of the alphabet.
LETTERS |= {chr(0x3B1 + i): name.removesuffix("_final") for i, name in enumerate(GREEK)}
LETTERS |= {chr(0x391 + i): name.capitalize() for i, name in enumerate(GREEK) if not name.endswith("_final")}


def transliterate(text: str) -> str:
    """ASCII letters for the letters of ``LETTERS`` and for letters with marks;
    anything else outside ASCII goes."""
    plain = "".join(LETTERS.get(c, c) for c in unicodedata.normalize("NFC", text))
    return unicodedata.normalize("NFKD", plain).encode("ascii", "ignore").decode("ascii")


def clean_name(name: str) -> str:
    """One name to snake_case ASCII: ``AccSpeciesName`` -> ``acc_species_name``."""
    text = name
    for old, new in NAME_REPLACEMENTS.items():
        text = text.replace(old, new)
    text = transliterate(text)
    # word boundaries inside camelCase and acronyms: fooBar, HTTPServer, ID2x
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^A-Za-z0-9]+", "_", text).strip("_").lower()
    if not text:
        return "x"
    if text[0].isdigit():
        return "x" + text
    return text


def clean_name_list(names: Sequence[str]) -> list[str]:
    """Clean every name, then suffix repeats with ``_2``, ``_3`` ... in order."""
    cleaned = [clean_name(n) for n in names]
    while len(set(cleaned)) != len(cleaned):
        seen: dict[str, int] = {}
        renamed = []
        for n in cleaned:
            seen[n] = seen.get(n, 0) + 1
            renamed.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
        cleaned = renamed
    return cleaned


#: "<name>_<YYYY-MM-DD>[_<n>][.ext]": the name, the date and its number.
ENTRY_PATTERN = r"^(.*?)(?:_([0-9]{4}-[0-9]{2}-[0-9]{2})(?:_([0-9]+))?)?(?:\.[A-Za-z0-9]+)?$"


def logical_name(entry: Column) -> Column:
    """An entry's name without its version and extension."""
    return F.regexp_extract(entry, ENTRY_PATTERN, 1)


def entry_version(entry: Column) -> Column:
    """(date, number) of an entry, in version order; an entry without a date
    is older than any dated one."""
    number = F.regexp_extract(entry, ENTRY_PATTERN, 3)
    return F.struct(
        F.regexp_extract(entry, ENTRY_PATTERN, 2).alias("date"),
        F.when(number == "", F.lit(0)).otherwise(number.try_cast("decimal(38,0)").cast("long")).alias("number"),
    )
