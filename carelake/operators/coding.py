"""Drug coding: drug-name service responses (XML) to ``(Drug, RxCUI, Concept)``.

Responses arrive as a payload table ``(drug, xml)``; they are decoded in Spark
with ``from_xml`` against a declared schema. Both nesting levels are declared as
arrays, so a group holding one concept and a group holding several decode the
same way. Responses that yield no concept (NULL or malformed XML, no group, no
concept in any group) are not lost: ``rejects`` reports them with the reason.
Surrounding whitespace of text values is trimmed, as XML-to-dict converters do.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from carelake.functions.columns import request_url
from carelake.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, join_small

# The public drug-name service's base address and the element
# names of its response document.
SERVICE_BASE = "https://rxnav.nlm.nih.gov/REST"
DRUGS_PATH = "/drugs?name="
ROW_TAG = "rxnormdata"

DRUG_GROUP_SCHEMA = ("drugGroup STRUCT<name: STRING, conceptGroup: ARRAY<STRUCT<tty: STRING, "
                     "conceptProperties: ARRAY<STRUCT<rxcui: STRING, name: STRING>>>>>")


def lookup_urls(drugs: DataFrame, drug: str = "Drug") -> DataFrame:
    """The request address per drug name, ``(Drug, request_url)``."""
    return drugs.select(F.col(drug).alias("Drug"),
                        request_url(SERVICE_BASE + DRUGS_PATH, drug).alias("request_url"))


def infer_schema(payloads: DataFrame, xml: str = "xml") -> StructType:
    """The schema of all responses together (every response is read, in parallel; malformed ones add
    nothing): the declared one with whatever other elements and attributes occur, as text. An element that
    repeats in any response is an array in all; the declared arrays stay arrays."""
    texts = payloads.where(F.col(xml).isNotNull()).select(F.col(xml).cast("string"))
    spark = payloads.sparkSession
    reader = spark.read.option("rowTag", ROW_TAG).option("inferSchema", "false").option("columnNameOfCorruptRecord", "_corrupt")
    lines = getattr(texts._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())  # stays in the JVM
    found = StructType.fromJson(json.loads(reader._jreader.xml(lines).schema().json()))
    return _merged(_parse(DRUG_GROUP_SCHEMA), StructType([f for f in found.fields if f.name != "_corrupt"]))


def _parse(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _merged(a: DataType, b: DataType) -> DataType:
    """``a`` with what only ``b`` has; an array if either is one, text where they cannot be reconciled."""
    if isinstance(a, ArrayType) or isinstance(b, ArrayType):
        a, b = (x.elementType if isinstance(x, ArrayType) else x for x in (a, b))
        return ArrayType(_merged(a, b))
    if isinstance(a, StructType) and isinstance(b, StructType):
        other = {f.name: f.dataType for f in b.fields}
        fields = [StructField(f.name, _merged(f.dataType, other.pop(f.name)) if f.name in other else f.dataType) for f in a.fields]
        return StructType(fields + [StructField(n, t) for n, t in other.items()])
    return a if isinstance(a, StructType) else b if isinstance(b, StructType) else StringType()


def parse_responses(payloads: DataFrame, drug: str = "drug", xml: str = "xml", schema: StructType | None = None) -> DataFrame:
    """``(drug, drugGroup, corrupt, missing)`` with the nested response decoded per row;
    ``corrupt`` holds the text of a response that did not parse. ``schema``: the declared one, or
    one found in the responses (``infer_schema``), which keeps elements that the declaration does not name."""
    ddl = DRUG_GROUP_SCHEMA if schema is None else schema.toDDL()
    parsed = F.from_xml(F.col(xml), f"{ddl}, _corrupt STRING",
                        {"rowTag": ROW_TAG, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return (payloads.select(F.col(drug).alias("drug"), F.col(xml).alias("__xml"), parsed.alias("__p"))
            .select("drug", F.col("__p.drugGroup").alias("drugGroup"),
                    F.when(F.col("__xml").isNotNull(), F.col("__p._corrupt")).alias("corrupt"),
                    F.col("__xml").isNull().alias("missing")))


def rejects(parsed: DataFrame) -> DataFrame:
    """Responses without a concept: ``(drug, reason)``, reason being ``missing`` (NULL
    response), ``malformed``, ``no group`` or ``no concept``."""
    groups = F.coalesce(F.size("drugGroup.conceptGroup"), F.lit(-1))
    concepts = F.coalesce(F.exists("drugGroup.conceptGroup", lambda g: F.coalesce(F.size(g["conceptProperties"]), F.lit(0)) > 0), F.lit(False))
    reason = (F.when(F.col("missing"), "missing").when(F.col("corrupt").isNotNull(), "malformed")
              .when(groups <= 0, "no group").when(~concepts, "no concept"))
    return parsed.select("drug", reason.alias("reason")).where("reason IS NOT NULL")


def flatten_concepts(parsed: DataFrame, extra: bool = False) -> DataFrame:
    """Groups -> concepts: ``(Drug, RxCUI, Concept)`` and, with ``extra``, a column per other element
    of a concept that the schema has (in its order). Two ``explode``s, both
    row-local (no shuffle); NULL or empty arrays produce no rows."""
    groups = parsed.select("drug", F.explode("drugGroup.conceptGroup").alias("g"))
    concepts = groups.select("drug", F.explode("g.conceptProperties").alias("c"))
    more = [f.name for f in concepts.schema["c"].dataType.fields if f.name not in ("rxcui", "name")] if extra else []
    return concepts.select(F.col("drug").alias("Drug"), F.col("c.rxcui").alias("RxCUI"), F.col("c.name").alias("Concept"),
                           *[F.col(f"c.`{n}`").alias(n) for n in more])


def json_roundtrip(parsed: DataFrame) -> DataFrame:
    """Decoded response -> JSON text -> decoded again, with the same schema."""
    group_type = parsed.schema["drugGroup"].dataType
    as_json = parsed.select("drug", F.to_json("drugGroup").alias("json"))
    return as_json.select("drug", F.from_json("json", group_type).alias("drugGroup"))


def code_drugs(drugs: DataFrame, concepts: DataFrame, drug: str = "Drug",
               max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, check: str = "count") -> DataFrame:
    """Attach concepts to each drug. Drugs without a concept drop out; a drug
    with several concepts gets several rows. The drug list is the small side:
    it is evaluated once, counted against the bound and broadcast, so the
    concept table is never shuffled (see ``join_small``)."""
    concepts = concepts.withColumnRenamed("Drug", drug) if drug != "Drug" else concepts
    return join_small(concepts, drugs, drug, "inner", max_rows=max_broadcast_rows, check=check)


def _esc(c):
    c = F.coalesce(c.cast("string"), F.lit(""))  # a NULL value becomes an empty element, not a lost row
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.regexp_replace(c, a, b)
    return c


def concept_payloads(concepts: DataFrame, drug: str, group: str, rxcui: str, name: str, bucket,
                     extra: dict[str, str] | None = None) -> DataFrame:
    """Build service-style response documents ``(drug, xml)`` from a concept table.

    One document per (drug, bucket): ``bucket`` is a column chosen by the caller
    that bounds how many concepts share a document, so no document, group or task
    grows with the data. Inside a document, concepts are grouped by ``group``; ``extra`` adds
    further elements to each concept (``{element: column}``).
    Used to replay service responses from tables.
    """
    c = concepts.select(F.col(drug).alias("drug"), bucket.alias("bucket"), F.col(group).alias("grp"),
                        F.col(rxcui).cast("string").alias("rxcui"), F.col(name).alias("name"),
                        *[F.col(c).alias(f"__x{i}") for i, c in enumerate((extra or {}).values())])
    # One shuffle serves both aggregations: hash partitioning on (drug, bucket)
    # already clusters every (drug, bucket, grp) group. Adaptive execution sizes
    # the partition count from the data.
    c = c.repartition("drug", "bucket")
    prop = F.concat(F.lit("<conceptProperties><rxcui>"), _esc(F.col("rxcui")), F.lit("</rxcui><name>"),
                    _esc(F.col("name")), F.lit("</name>"),
                    *[part for i, e in enumerate(extra or {}) for part in (F.lit(f"<{e}>"), _esc(F.col(f"__x{i}")), F.lit(f"</{e}>"))],
                    F.lit("</conceptProperties>"))
    groups = (c.groupBy("drug", "bucket", "grp")
              .agg(F.array_join(F.array_sort(F.collect_list(prop)), "").alias("props"))
              .select("drug", "bucket",
                      F.concat(F.lit("<conceptGroup><tty>"), _esc(F.col("grp")), F.lit("</tty>"),
                               F.col("props"), F.lit("</conceptGroup>")).alias("g")))
    docs = (groups.groupBy("drug", "bucket")
            .agg(F.array_join(F.array_sort(F.collect_list("g")), "").alias("groups")))
    return docs.select("drug", "bucket", F.concat(
        F.lit(f"<{ROW_TAG}><drugGroup><name>"), _esc(F.col("drug")), F.lit("</name>"),
        F.col("groups"), F.lit(f"</drugGroup></{ROW_TAG}>")).alias("xml"))
