"""Small register rows: a default row with overrides, and CSV files made of them."""

from __future__ import annotations

from pathlib import Path

from civiclake.register.rulebook import BOOK
from civiclake.register.schema import COLUMNS

#: A home purchase that was granted, in a county of our choice.
OWN = {
    "activity_year": "2021",
    "lei": "OWNBANK0000000000042",
    "state_code": "VT",
    "county_code": "50007",
    "derived_msa_md": "15540",
    "census_tract": "50007000100",
    "loan_amount": "240000.0",
    "property_value": "300000",
    "income": "96",
    "combined_loan_to_value_ratio": "75.5",
    "interest_rate": "4.25",
    "loan_term": "180",
    "debt_to_income_ratio": "30%-<36%",
    "derived_race": "White",
    "derived_ethnicity": "Not Hispanic or Latino",
    "derived_sex": "Female",
    "denial_reason_1": "10",
    "denial_reason_2": "NA",
    "denial_reason_3": "NA",
    "denial_reason_4": "NA",
    "co_applicant_sex": "5",
}


def _by_rule() -> dict[str, str]:
    """Coded fields: the first code, 'no', or the first listed text of the rulebook."""
    found = {}
    for field in BOOK.fields:
        if field.kind == "yesno":
            found[field.source] = "2"
        elif field.domain or field.listed:
            found[field.source] = str((field.domain or field.listed)[0])
    return found


DEFAULT = {**_by_rule(), **OWN}


def row(**changes: str) -> list[str]:
    values = {**{c: "NA" for c in COLUMNS}, **DEFAULT, **changes}
    assert set(values) == set(COLUMNS)
    return [values[c] for c in COLUMNS]


def csv_text(rows: list[list[str]], header: list[str] | None = None, final_newline: bool = True) -> str:
    lines = [",".join(header or COLUMNS), *[",".join(r) for r in rows]]
    return "\n".join(lines) + ("\n" if final_newline else "")


def write_csv(path: Path, rows: list[list[str]], **options) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(csv_text(rows, **options), encoding="utf-8")
    return str(path)
