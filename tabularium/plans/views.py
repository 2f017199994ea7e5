"""Named views: SQL text with declared inputs and output, registered, previewed and exported."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from ..contracts import PRODUCT_SCHEMAS, same_schema
from ..operators.search import check_limit


@dataclass(frozen=True)
class View:
    name: str
    sql: str
    inputs: tuple[str, ...]
    output: str
    purpose: str | None = None


VIEWS: dict[str, View] = {}


def register(view: View, into: dict[str, View] | None = None) -> View:
    into = VIEWS if into is None else into
    if not view.name:
        raise ValueError("a view has a name")
    if view.name in into:
        raise ValueError(f"view {view.name} is there already")
    if not view.sql.strip():
        raise ValueError(f"view {view.name} has no SQL")
    if not view.inputs or not all(isinstance(i, str) and i for i in view.inputs):
        raise ValueError(f"view {view.name}: inputs are names")
    if view.output not in PRODUCT_SCHEMAS:
        raise ValueError(f"view {view.name}: unknown output {view.output}")
    into[view.name] = view
    return view


register(View("empresas_ativas", "SELECT * FROM cnpjs WHERE situacao_cadastral = '02'", ("cnpjs",), "cnpjs", "Establishments whose published status is active."))
register(View("socios_de_raizes_ativas", "SELECT s.* FROM socios s LEFT SEMI JOIN (SELECT cnpj_base FROM raizes WHERE qtd_estabelecimentos_ativos > 0) r ON s.cnpj_base = r.cnpj_base", ("socios", "raizes"), "socios", "Partnerships of roots with an active establishment."))


def view(spark: SparkSession, name: str, **args) -> DataFrame:
    """A view over the session's tables; named parameters are bound, not spliced."""
    if name not in VIEWS:
        raise ValueError(f"unknown view {name}; there are {', '.join(sorted(VIEWS))}")
    return spark.sql(VIEWS[name].sql, args=args or None)


def preview(spark: SparkSession, name: str, limit: int = 20) -> list[dict]:
    """The first rows, after the view's columns were compared with its declared output."""
    check_limit(limit)
    df = view(spark, name)
    if not same_schema(df, PRODUCT_SCHEMAS[VIEWS[name].output]):
        raise ValueError(f"view {name} does not give {VIEWS[name].output}")
    return [r.asDict(recursive=True) for r in df.limit(limit).collect()]


def attach_views(spark: SparkSession) -> None:
    for name in VIEWS:
        view(spark, name).createOrReplaceTempView(name)


def export(views: dict[str, View] | None = None) -> str:
    return json.dumps([asdict(v) | {"inputs": list(v.inputs)} for _, v in sorted((views or VIEWS).items())], ensure_ascii=False, indent=2)


def parse_view(markdown: str) -> View:
    """A view from a document's front matter: name, sql, inputs, output, purpose."""
    if not markdown.startswith("---"):
        raise ValueError("no front matter")
    head = markdown.split("---", 2)[1]
    found: dict = {}
    key, block = None, False
    for line in head.splitlines():
        if line[:1].strip():
            key, _, value = line.partition(":")
            value = value.strip()
            block = value == "|"
            found[key] = "" if block or not value else value
        elif key and line.strip():
            item = line.strip()
            if block:
                found[key] += item + "\n"
            elif item.startswith("- "):
                found[key] = [*(found[key] or []), item[2:].strip()]
    if found.get("type") != "View":
        raise ValueError("not a view")
    inputs = found.get("inputs") or []
    return View(found.get("name") or "", found.get("sql") or "", tuple(inputs), found.get("output") or "", found.get("purpose") or None)
