"""Ten actions on a catalog from the command line: python -m lakeread.cli --action A --arg TEXT_OR_FILE.

Their messages are fixed values, which scripts may read.
"""

from __future__ import annotations

import argparse
import json
import os
import re
import sys
import traceback

from pyspark.sql import SparkSession

from .operators import show
from .sources.catalog import Catalog, TableSchema, connection_conf
from .sources.load import read_csv
from .sources.populate import populate

CATALOG_VARIABLE = "LAKEREAD_CATALOG"
PAGE = 64  # rows that are shown at once on a terminal


def _content(text: str) -> str:
    """The text itself, or what the file of that name holds."""
    if os.path.isfile(text):
        with open(text) as f:
            return f.read()
    return text


def _names(text: str, parts: int) -> list[str]:
    names = text.strip().split(".", parts - 1)
    if len(names) != parts or not all(names):
        raise ValueError(f"{parts} names joined by a dot are needed: {text}")
    return names


def show_databases(catalog: Catalog, arg: str) -> None:
    print("Databases in catalog:")
    for name in catalog.list_databases():
        print(f"\t{name}")


def create_database(catalog: Catalog, arg: str) -> None:
    print(f"Create database '{arg}' successfully." if catalog.create_database(arg) else f"Database '{arg}' already exists.")


def drop_database(catalog: Catalog, arg: str) -> None:
    tables = catalog.drop_database(arg)
    if tables is None:
        print(f"Database '{arg}' does not exist.")
        return
    for table in tables:
        print(f"Dropping table '{arg}.{table}' ...")
    print(f"Drop database '{arg}' successfully.")


def show_tables(catalog: Catalog, arg: str) -> None:
    if not catalog.database_exists(arg):
        print(f"Database '{arg}' does not exist.")
        return
    print(f"Tables in database '{arg}':")
    for name in catalog.list_tables(arg):
        print(f"\t{name}")


def create_table(catalog: Catalog, arg: str) -> None:
    p = json.loads(arg)
    options = {k: str(v) for k, v in (p.get("schemaOptions") or {}).items()}
    schema = TableSchema([(c["name"], c["type"]) for c in p["columns"]], p.get("primaryKeys") or [], p.get("partitionKeys") or [], options)
    catalog.create_table(p["database"], p["table"], schema, options.get("file.format", "parquet"), int(options.get("bucket", 0)))
    print(f"Create table '{p['database']}.{p['table']}' successfully.")


def drop_table(catalog: Catalog, arg: str) -> None:
    database, table = _names(arg, 2)
    print(f"Drop table '{arg}' successfully." if catalog.drop_table(database, table) else f"Table '{arg}' does not exist.")


def show_table_schema(catalog: Catalog, arg: str) -> None:
    database, table = _names(arg, 2)
    if not catalog.table_exists(database, table):
        print(f"Table '{arg}' does not exist.")
        return
    print("\n".join([f"Table '{arg}' schema:", *catalog.schema(database, table).lines()]))


def populate_table(catalog: Catalog, arg: str) -> None:
    p = json.loads(arg)
    rows = int(p.get("rows", 16))
    made = populate(catalog.spark, catalog.schema(p["database"], p["table"]).spark(), rows, float(p.get("nullableRate", 0.1)), int(p.get("seed", 0)))
    catalog.write(p["database"], p["table"], made, overwrite=True)
    print(f"Populate table '{p['database']}.{p['table']}' successfully, {rows} rows have been generated.")


def load_table(catalog: Catalog, arg: str) -> None:
    p = json.loads(arg)
    if p.get("fileType", "csv").lower() != "csv":
        raise ValueError(f"unsupported file type: {p['fileType']}")
    schema = catalog.schema(p["database"], p["table"]).spark()
    rows = catalog.write(p["database"], p["table"], read_csv(catalog.spark, p["filePath"], schema, p.get("delimiter", ","), p.get("quote", '"')))
    print(f"Load table '{p['database']}.{p['table']}' successfully, {rows} rows have been inserted.")


def show_data(catalog: Catalog, arg: str) -> None:
    m = re.fullmatch(r"(?s)([^.]+)\.([^.{]+)(?:\.\{([^}]*)\})?", arg.strip())
    if not m:
        raise ValueError(f"db.table or db.table.{{c1,c2}} is needed: {arg}")
    if not catalog.table_exists(m[1], m[2]):
        print(f"Table '{m[1]}.{m[2]}' does not exist.")
        return
    names = [c.strip() for c in (m[3] or "").split(",") if c.strip()]
    paged = sys.stdin.isatty() and sys.stdout.isatty()
    for n, line in enumerate(show.lines(catalog.read(m[1], m[2]), names, PAGE if paged else 0)):
        if paged and n and n % (PAGE + 1) == 0:
            input("Press enter to continue...")
        print(line)


ACTIONS = {
    "SHOW_DATABASES": show_databases, "CREATE_DATABASE": create_database, "DROP_DATABASE": drop_database, "SHOW_TABLES": show_tables,
    "CREATE_TABLE": create_table, "DROP_TABLE": drop_table, "SHOW_TABLE_SCHEMA": show_table_schema, "POPULATE_TABLE": populate_table,
    "LOAD_TABLE": load_table, "SHOW_DATA": show_data,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lakeread", description=__doc__)
    parser.add_argument("--catalog", help=f"catalog parameters as JSON or a file of it; else the variable {CATALOG_VARIABLE}")
    parser.add_argument("--action", help="one of " + ", ".join(ACTIONS))
    parser.add_argument("--arg", help="the action's argument, as text or a file; all actions but SHOW_DATABASES need it")
    parser.add_argument("--verbose", action="store_true", help="show the stack of an error")
    given = parser.parse_args(argv)
    params = given.catalog or os.environ.get(CATALOG_VARIABLE)
    action = ACTIONS.get((given.action or "").upper())
    wrong = (
        f"--catalog is mandatory if env variable '{CATALOG_VARIABLE}' is not set." if not params
        else "Please use --action to specify action." if not given.action
        else "Wrong action type." if not action
        else f"--arg is mandatory if you use --action '{given.action.upper()}'" if given.arg is None and action is not show_databases
        else None
    )
    if wrong:
        print(wrong)
        parser.print_help()
        return
    try:
        conf = connection_conf(_content(params))
        action(Catalog(spark or SparkSession.builder.config(map=conf).getOrCreate()), _content(given.arg or ""))
    except Exception as e:
        traceback.print_exc() if given.verbose else print(e, file=sys.stderr)


if __name__ == "__main__":
    main()
