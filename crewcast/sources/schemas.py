"""Declared table schemas as DDL texts, which Spark's readers take as they are. Every column may be null."""

from __future__ import annotations

import calendar
import json

from pyspark.sql import DataFrame, functions as F, types as T


def month_range(first_year: int, first_month: int, count: int, full_names: bool = False) -> list[str]:
    """Month column names such as ``Jan_2025`` or, with full names, ``January_2025``."""
    names = calendar.month_name if full_names else calendar.month_abbr
    months = [(first_year * 12 + first_month - 1 + i) for i in range(count)]
    return [f"{names[m % 12 + 1]}_{m // 12}" for m in months]


def _ddl(text: str) -> str:
    return " ".join(text.split())


_EFFICIENCY_MONTHS = ", ".join(f"{m} double" for m in month_range(2025, 1, 24))
_PROJECT_MONTHS = ", ".join(f"{m} double" for m in month_range(2024, 7, 18, full_names=True))

DAILY_FACT = _ddl("""
    Appointment_Timestamp date, Work_Force string, Job_Assignment_Status string, Job_Type_Cd string,
    Product_Category string, Technology string, Work_Order_Action string, Work_Order_Action_Grp string,
    District string, Province string, Product_Key string, Product string, Product_Grp string,
    SWT decimal(38,9), AWT decimal(38,9), JobCount bigint, WorkOrderCount bigint""")
PANEL = _ddl("""
    Appointment_Month date, Series_Identifier string, District string, Product string, Technology string,
    Work_Order_Action string, Work_Force string, SWT decimal(38,9), AWT decimal(38,9)""")
PREDICTION_INPUT = _ddl("""
    Series_Identifier string, Appointment_Month date, District string, Product string, Technology string,
    Work_Order_Action string, Work_Force string, SWT decimal(38,9), SWT_Type string""")
FORECAST = _ddl("""
    Forecast_Date string, Appointment_Month string, District string, Product string, SWT double, SWT_Type string,
    Series_Identifier string, Technology string, Work_Force string, Work_Order_Action string,
    explanation struct<attributions: array<struct<featureAttributions: struct<Appointment_Month: double, SWT: double,
    District: double, Product: double, Technology: double, Work_Order_Action: double, Work_Force: double>,
    outputDisplayName: string>>>, predicted_SWT struct<value: double>""")
DISPLAY = _ddl("""
    Forecast_Date date, Appointment_Month date, District string, Region_Type string, Product string,
    Product_Grp string, Technology string, Work_Order_Action string, Work_Order_Action_Grp string, Work_Force string,
    AWT_Historical double, SWT_Historical double, SWT_Predicted double""")
DISTRICTS = _ddl("""
    province string, region string, district string, service_area_clli string, service_area_name string,
    migration string, district_old string, region_type string""")
EFFICIENCIES = _ddl(f"""
    Program_Name string, Initiative_Name string, Brief_Description string, Owner string, Start_Date date,
    Notes string, Products_Impacted string, Job_Types_Impacted string, Region_Impacted string,
    Type_of_Reduction string, {_EFFICIENCY_MONTHS}""")
SPECIAL_PROJECTS = _ddl(f"""
    Project_Name string, Project_Prime string, Product string, Job_Type string, RGU_Tracking string, Region string,
    Special_Project string, Start_Date string, End_Date string, Notes string, {_PROJECT_MONTHS}""")
VOLUMES = _ddl("""
    Appointment_Month date, Product string, Actual_RGU bigint, Forecasted_RGU bigint, Adjusted_RGU bigint""")
VOLUME_SHEET = _ddl("""
    Month bigint, Year bigint, Product string, RGU_Type string, Original_Actual bigint, Adjusted_Actual bigint,
    Notes string""")
CORRECTIONS = _ddl("""
    Forecast_Date string, Appointment_Month date, Product string, SWT_Forecasted_RGU double,
    SWT_Adjusted_RGU double, Alpha_Correction_Forecasted double, Lag_Correction_Forecasted bigint,
    Alpha_Correction_Adjusted double, Lag_Correction_Adjusted bigint""")
PRODUCT_NAMES = _ddl("work_order_product_name string, RGU_product_name string")

_TYPES = {
    "STRING": "string", "DATE": "date", "TIMESTAMP": "timestamp", "DATETIME": "timestamp_ntz",
    "NUMERIC": "decimal(38,9)", "FLOAT": "double", "FLOAT64": "double", "INTEGER": "bigint", "INT64": "bigint",
    "BOOLEAN": "boolean", "BOOL": "boolean",
}


def from_json(text: str) -> str:
    """Schema text from a JSON list of ``{name, type, mode, fields}`` entries."""

    def ddl(field: dict) -> str:
        kind = field["type"].upper()
        if kind in ("RECORD", "STRUCT"):
            inner = "struct<" + ", ".join(f"`{f['name']}`: {ddl(f)}" for f in field["fields"]) + ">"
        elif kind in _TYPES:
            inner = _TYPES[kind]
        else:
            raise ValueError(f"unknown type {kind} of {field['name']}")
        return f"array<{inner}>" if field.get("mode", "").upper() == "REPEATED" else inner

    return _ddl(", ".join(f"`{f['name']}` {ddl(f)}" for f in json.loads(text)))


def conform(rows: DataFrame, schema: str) -> DataFrame:
    """Columns in declared order and type; a column the rows lack becomes null."""
    have = set(rows.columns)
    return rows.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in T.StructType.fromDDL(schema)
    ])
