"""States, census regions and divisions as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Division | region | codes of its states; territories; names.
DIVISIONS = """
New England | Northeast | CT ME MA NH RI VT
Middle Atlantic | Northeast | NJ NY PA
East North Central | Midwest | IN IL MI OH WI
West North Central | Midwest | IA KS MN MO NE ND SD
South Atlantic | South | DE DC FL GA MD NC SC VA WV
East South Central | South | AL KY MS TN
West South Central | South | AR LA OK TX
Mountain | West | AZ CO ID MT NV NM UT WY
Pacific | West | AK CA HI OR WA
"""
TERRITORIES = "PR GU VI AS MP FM PW"
NAMES = """
ALABAMA AL, ALASKA AK, ARIZONA AZ, ARKANSAS AR, CALIFORNIA CA, COLORADO CO, CONNECTICUT CT, DELAWARE DE,
DISTRICT OF COLUMBIA DC, FLORIDA FL, GEORGIA GA, HAWAII HI, IDAHO ID, ILLINOIS IL, INDIANA IN, IOWA IA,
KANSAS KS, KENTUCKY KY, LOUISIANA LA, MAINE ME, MARYLAND MD, MASSACHUSETTS MA, MICHIGAN MI, MINNESOTA MN,
MISSISSIPPI MS, MISSOURI MO, MONTANA MT, NEBRASKA NE, NEVADA NV, NEW HAMPSHIRE NH, NEW JERSEY NJ,
NEW MEXICO NM, NEW YORK NY, NORTH CAROLINA NC, NORTH DAKOTA ND, OHIO OH, OKLAHOMA OK, OREGON OR,
PENNSYLVANIA PA, RHODE ISLAND RI, SOUTH CAROLINA SC, SOUTH DAKOTA SD, TENNESSEE TN, TEXAS TX, UTAH UT,
VERMONT VT, VIRGINIA VA, WASHINGTON WA, WEST VIRGINIA WV, WISCONSIN WI, WYOMING WY, PUERTO RICO PR, GUAM GU,
U.S. VIRGIN ISLANDS VI, VIRGIN ISLANDS VI, AMERICAN SAMOA AS, NORTHERN MARIANA ISLANDS MP, MICRONESIA FM,
REPUBLIC OF PALAU PW
"""
PACIFIC_NORTHWEST = ("WA", "OR", "ID")

DIVISION, REGION = {}, {}
for _line in DIVISIONS.strip().splitlines():
    _division, _region, _codes = (x.strip() for x in _line.split("|"))
    DIVISION |= dict.fromkeys(_codes.split(), _division)
    REGION |= dict.fromkeys(_codes.split(), _region)
STATE_NAMES = {x.strip()[:-3]: x.strip()[-2:] for x in NAMES.replace("\n", " ").split(",")}
VALID_STATES = sorted({*DIVISION, *TERRITORIES.split()})


def lookup(values: dict[str, str], key: Column) -> Column:
    """Value of a small fixed map, null where the key is absent."""
    return F.try_element_at(F.create_map(*map(F.lit, chain.from_iterable(values.items()))), key)


def geography(state: Column) -> dict[str, Column]:
    """census_region, census_division, pnw and headline_us of a state code; null counts as a territory."""
    known = F.coalesce(state, F.lit(""))
    return {
        "census_region": F.coalesce(lookup(REGION, known), F.lit("Territory")),
        "census_division": F.coalesce(lookup(DIVISION, known), F.lit("Territory")),
        "pnw": F.when(known.isin(*PACIFIC_NORTHWEST), "PNW").otherwise("Not PNW"),
        "headline_us": F.when(known.isin(*REGION), "yes").otherwise("no"),
    }


def is_valid_state(state: Column) -> Column:
    """Whether a code is one of the states or territories; false for null."""
    return F.coalesce(state.isin(*VALID_STATES), F.lit(False))
