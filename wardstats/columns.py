"""Names of the admission columns, in the raw table and in the facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONDITION = "condition"
ADMISSION_TYPE = "admission_type"
PROVIDER = "provider"
COMBO = (CONDITION, ADMISSION_TYPE)


@dataclass(frozen=True)
class ColumnMap:
    """Where each admission field sits in a raw table.

    One raw row is one admission record, not one patient. The defaults are the
    field names of the source table (fixed values).
    """

    condition: str = "Medical Condition"
    admission_type: str = "Admission Type"
    provider: str = "Insurance Provider"
    billing: str = "Billing Amount"
    admit: str = "Date of Admission"
    discharge: str = "Discharge Date"

    def dimensions(self) -> dict[str, str]:
        """Fact name -> raw name of the three grouping columns."""
        return {
            CONDITION: self.condition,
            ADMISSION_TYPE: self.admission_type,
            PROVIDER: self.provider,
        }


def raw_column(name: str) -> Column:
    """A column by its literal name, which may hold spaces, dots, % or $."""
    return F.col("`" + name.replace("`", "``") + "`")


def same_name(a: str, b: str) -> bool:
    return a.lower() == b.lower()


def type_of(raw: DataFrame, name: str) -> T.DataType | None:
    """Type of a raw column, found like Spark finds it, or None."""
    return next((f.dataType for f in raw.schema.fields if same_name(f.name, name)), None)
