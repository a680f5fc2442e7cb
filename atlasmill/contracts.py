"""Table contracts: static schema checks for free, data checks as one aggregate on request."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table does not keep its contract."""


@dataclass(frozen=True)
class Contract:
    columns: dict[str, str]
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    strict: bool = False
    name: str = field(default="table")


NODE = Contract({"id": "string", "category": "string", "all_categories": "array<string>"}, required=("id", "category"), unique=("id",), name="nodes")
EDGE = Contract({"subject": "string", "predicate": "string", "object": "string"}, required=("subject", "predicate", "object"), unique=("subject", "predicate", "object"), name="edges")


def validate(df: DataFrame, contract: Contract, data: bool = False) -> DataFrame:
    """``df`` itself, if its schema (and with ``data`` its rows) keep the contract."""
    have = dict(df.dtypes)
    wrong = [f"{c}: {have.get(c, 'missing')} instead of {t}" for c, t in contract.columns.items() if have.get(c) != t]
    if contract.strict:
        wrong += [f"{c}: superfluous" for c in have if c not in contract.columns]
    if not wrong and data:
        nulls = [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in contract.required]
        row = df.agg(*nulls, F.count(F.lit(1)).alias("rows")).first().asDict()
        wrong = [f"{k}: {v} rows" for k, v in row.items() if k != "rows" and v]
        if contract.unique and df.groupBy(*contract.unique).count().filter("count > 1").limit(1).count():
            wrong.append(f"{', '.join(contract.unique)}: not unique")
    if wrong:
        raise ContractError(f"{contract.name}: " + "; ".join(wrong))
    return df
