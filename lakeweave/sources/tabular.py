"""Sheets as rows of cells to typed elements, in built-in operators: header detection, row types, attributes, running sections."""

from __future__ import annotations

import csv
import io
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words that mark sections, subtotals and header columns.
SECTION = r"(?iu)^\s*(Шифр|Раздел|Итого|Всего|Система|Подраздел|Глава)"
SUBTOTAL = r"(?iu)(Итого|Всего|итого\s+по)"
HEADERS = {
    "number": ("№", "п/п", "номер", "n п/п", "№ п/п"), "code": ("обоснование", "обосно-", "шифр", "код", "код ресурса"),
    "name": ("наименование", "наим.", "наименование материала", "наименование работ", "наименование работ и затрат"),
    "unit": ("единица", "ед. изм", "ед.", "измере-", "измерения"), "quantity": ("количество", "кол-во", "кол.", "коли-"), "note": ("примечание", "прим.", "примеч."),
}
HEADER_ROWS = 50


def row_type(cells: Column) -> Column:
    """data, section_header, subtotal or column_number."""
    filled = F.filter(cells, lambda c: c.isNotNull() & (c != ""))
    joined = F.array_join(filled, " ")
    short = F.forall(filled, lambda c: c.rlike(r"^\d{1,2}$"))
    one = F.when(joined.rlike(SECTION), "section_header").when(joined.rlike(SUBTOTAL), "subtotal").otherwise("data")
    more = F.when(short, "column_number").when(joined.rlike(SUBTOTAL), "subtotal").when(F.element_at(filled, 1).rlike(SECTION), "section_header").otherwise("data")
    return F.when(F.size(filled) < 2, one).otherwise(more)


def header_map(cells: Column) -> Column:
    """Column index (from 0) of each field whose words a cell contains: the first such cell."""
    low = F.transform(cells, lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    first = lambda words: F.array_min(F.filter(F.transform(low, lambda c, i: F.when(reduce(lambda a, b: a | b, [c.contains(w) for w in words]), i)), lambda i: i.isNotNull()))
    return F.map_filter(F.create_map(*[x for name, words in HEADERS.items() for x in (F.lit(name), first(words))]), lambda k, v: v.isNotNull())


def sheet_elements(rows: DataFrame) -> DataFrame:
    """Elements of rows (sheet, row, cells array<string>). The header is the row of the first 50 with the most fields, two at least."""
    cells = F.transform("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))))
    typed = rows.select("sheet", "row", cells.alias("cells")).withColumn("map", header_map(F.col("cells")))
    heads = typed.where((F.col("row") < HEADER_ROWS) & (F.size("map") >= 2)).groupBy("sheet").agg(F.max(F.struct(F.size("map").alias("n"), (-F.col("row")).alias("neg"), F.to_json("map").alias("m"))).alias("h"))
    heads = heads.select("sheet", (-F.col("h.neg")).alias("head_row"), F.from_json("h.m", "map<string,int>").alias("fields"))
    body = typed.drop("map").join(heads, "sheet", "left").where(F.col("head_row").isNull() | (F.col("row") > F.col("head_row")))
    body = body.withColumn("row_type", row_type(F.col("cells"))).where("row_type <> 'column_number' AND exists(cells, c -> c <> '')")
    fields = F.coalesce("fields", F.create_map().cast("map<string,int>"))
    known = F.map_filter(F.transform_values(fields, lambda k, i: F.coalesce(F.get("cells", i), F.lit(""))), lambda k, v: v != "")
    loose = F.filter(F.transform("cells", lambda c, i: F.struct(F.concat(F.lit("col_"), i.cast("string")).alias("key"), F.when(~F.array_contains(F.map_values(fields), i), c).alias("value"))), lambda e: e["value"].isNotNull() & (e["value"] != ""))
    body = body.withColumn("attributes", F.map_concat(known, F.map_from_entries(loose)))
    at = lambda k: F.coalesce(F.try_element_at("attributes", F.lit(k)), F.lit(""))
    measure = F.when((at("unit") != "") & (at("quantity") != ""), F.concat(F.lit(" - "), at("quantity"), F.lit(" "), at("unit"))).when(at("unit") != "", F.concat(F.lit(" ["), at("unit"), F.lit("]"))).otherwise("")
    named = F.concat(at("name"), F.when(at("code") != "", F.concat(F.lit(" ("), at("code"), F.lit(")"))).otherwise(""), measure)
    plain = F.array_join(F.map_values(F.map_filter("attributes", lambda k, v: ~(k.startswith("col_") | k.startswith("number")))), " ")
    text = F.when(at("name") != "", named).when(plain != "", plain).otherwise(F.array_join(F.filter("cells", lambda c: F.length(c) > 1), " "))
    order = Window.partitionBy("sheet").orderBy("row")
    section = F.last(F.when(F.col("row_type") == "section_header", F.array_join(F.filter("cells", lambda c: c != ""), " ")), True).over(order)
    return body.select("sheet", "row", text.alias("text"), F.when(F.col("row_type") == "data", "data").otherwise("section_header").alias("element_type"), "row_type", "attributes", F.coalesce(section, F.lit("")).alias("section"))


#: Encodings in the order in which they are tried.
ENCODINGS = ("utf-8-sig", "utf-8", "cp1251", "latin-1")


def csv_rows(content: bytes) -> list[list[str]]:
    """Cells of a CSV file in the first encoding that fits all its bytes."""
    for encoding in ENCODINGS:
        try:
            text = content.decode(encoding)
        except UnicodeDecodeError:
            continue
        return [[c.strip() for c in row] for row in csv.reader(io.StringIO(text, newline=""))]
    return []


def csv_elements(spark, path: str) -> DataFrame:
    """Elements of CSV files' rows; the encoding is found for each file."""

    def read(frames):
        for pdf in frames:
            for sheet, content in zip(pdf["path"], pdf["content"], strict=True):
                rows = csv_rows(content)
                yield pd.DataFrame({"sheet": [sheet] * len(rows), "row": range(len(rows)), "cells": rows})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return sheet_elements(files.mapInPandas(read, "sheet string, row long, cells array<string>"))
