"""Brute-force, row-by-row emulation of the original per-trait loop.

Deliberately literal (a loop per trait, lists kept in file order, Python's
``None == None`` standing for R's NA-matches-NA) so it shares no structure
with the set-based Spark plan it checks.
"""

from __future__ import annotations

import math
import re

NUMBER = re.compile(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$")
SPECIAL = re.compile(r"^[+-]?(inf|infinity|nan)$")


def parse(text):
    if text is None:
        return None
    t = text.strip()
    if NUMBER.match(t) or SPECIAL.match(t.lower()):
        return float(t)
    return None


def emulate_trait_table(rows, exclude, catalog, invert, scope="global"):
    """rows: dicts in file order. Returns a list of result dicts.
    ``scope="per_trait"`` keeps an item only for the trait it was seen with."""
    traits = sorted({r["TraitID"] for r in rows if r["TraitID"] is not None})
    selection = {}
    for t in traits:
        obs = {r["ObservationID"] for r in rows if r["TraitID"] == t and r["ObservationID"] is not None}
        others = [x for x in traits if x != t]
        selection[t] = [r for r in rows if r["ObservationID"] in obs and r["TraitID"] not in others]
    overview = []
    for t in traits:
        for r in selection[t]:
            if r["TraitID"] == t and (t, r["DataID"], r["DataName"]) not in overview:
                overview.append((t, r["DataID"], r["DataName"]))
    keep_all = [item for _, item, _ in overview if item not in exclude]
    result = []
    for t in traits:
        keep = keep_all if scope == "global" else [i for t2, i, _ in overview if t2 == t and i not in exclude]
        values = {}
        for r in selection[t]:
            if r["DataID"] in keep:
                key = (r["Dataset"], r["AccSpeciesName"], r["ObservationID"])
                if key not in values:
                    values[key] = r
        values = {k: r for k, r in values.items() if r["OrigValueStr"] is not None}
        first_cov = {}
        for r in selection[t]:
            if r["TraitID"] is None and r["DataID"] not in exclude and r["DataID"] not in keep:
                name = "NA" if r["DataName"] is None else r["DataName"]
                key = (r["Dataset"], r["AccSpeciesName"], r["ObservationID"], name)
                if key not in first_cov:
                    first_cov[key] = r
        wide = {}
        for (ds, sp, ob, name), r in first_cov.items():
            if r["OrigValueStr"] is not None:
                wide.setdefault((ds, sp, ob), {})[name] = r["OrigValueStr"]
        for key, r in values.items():
            if key not in wide:
                continue
            value = parse(r["OrigValueStr"])
            domain, full = catalog.get(str(t), (None, None))
            unit = r["UnitName"]
            if domain is None:
                value, unit = None, None
            elif domain in invert:
                if value is not None:
                    value = math.copysign(math.inf, value) if value == 0 else 1.0 / value
                unit = invert[domain]
            result.append(
                {
                    "dataset": key[0],
                    "acc_species_name": key[1],
                    "trait_value": value,
                    "trait_domain": domain,
                    "trait_full_name": full,
                    "observation_id": key[2],
                    "orig_value_str": r["OrigValueStr"],
                    "unit_name": unit,
                    "covariates": wide[key],
                }
            )
    return result
