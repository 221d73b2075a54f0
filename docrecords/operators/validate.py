"""Contract rules as one row-local pass: every violation becomes a row."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrecords.operators.rows import pin, unnest
from docrecords.schemas import (
    ADDRESS_PARTS,
    HEADER_AMOUNTS,
    HEADER_DATES,
    INVOICE_HEADER,
    LINE_ITEM,
    PAYMENT_TERMS,
)

# --- fixed values: the contract ------------------------------------------------

# Fields that must hold a value.
REQUIRED = (
    "orderNumber",
    "vendorName",
    "invoiceNumber",
    "invoiceDate",
    "purchaseOrderNumber",
    "branch",
    "warehouse",
    "discountAmount",
    "freightAmount",
    "totalAmount",
    "subtotalAmount",
    "shippingAddress",
    "remittanceAddress",
    "paymentTerms",
)
REQUIRED_PARTS = tuple(
    f"{struct}.{part}" for struct in ("shippingAddress", "remittanceAddress") for part in ADDRESS_PARTS
) + ("paymentTerms.termsNetDuedays",)

# Text fields that must not be blank when they hold a value.
NOT_BLANK = (
    "orderNumber",
    "vendorName",
    "invoiceNumber",
    "purchaseOrderNumber",
    "shippingAddress.address",
    "shippingAddress.city",
    "remittanceAddress.address",
    "remittanceAddress.city",
)
NOT_BLANK_IN_LINES = ("productCode", "uom")

CODE = r"^\d{3}$"
STATE = r"^[A-Z]{2}$"
ZIP = r"^\d{5}(-\d{4})?$"
ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
PATTERNS = {
    "branch": CODE,
    "warehouse": CODE,
    "shippingAddress.state": STATE,
    "shippingAddress.zip": ZIP,
    "remittanceAddress.state": STATE,
    "remittanceAddress.zip": ZIP,
}
NOT_NEGATIVE = HEADER_AMOUNTS + tuple(f"paymentTerms.{f.name}" for f in PAYMENT_TERMS.fields)
NOT_NEGATIVE_IN_LINES = ("quantityShipped", "weightShipped", "unitPrice", "lineTotal")

# --- rules -----------------------------------------------------------------------

TOP_LEVEL = ("invoiceHeader", "lineItems", "flags", "barcodes")
VIOLATIONS = "array<struct<rule: string, field: string, value: string>>"

# A rule set gives the violations of one record as ARRAY<STRUCT<rule, field, value>>.
RuleSet = Callable[[], Column]


def _header(field: str) -> Column:
    return F.col(f"invoice_header.{field}")


def _violation(failed: Column, rule: str, field: str | Column, value: Column) -> Column:
    name = F.lit(field) if isinstance(field, str) else field
    row = F.struct(F.lit(rule).alias("rule"), name.alias("field"), value.cast("string").alias("value"))
    return F.when(failed, row)


def _found(*violations: Column) -> Column:
    return F.array_compact(F.array(*violations))


def _per_line(check: Callable[[Column], list[Column]]) -> Column:
    """Violations of all line items, in line order; none when there are no lines."""
    lines = F.coalesce(F.transform("line_items", lambda x: _found(*check(x))), F.array())
    return F.flatten(lines)


def _line_field(item: Column, name: str) -> Column:
    number = F.coalesce(item["lineNumber"].cast("string"), F.lit("?"))
    return F.concat(F.lit("lineItems["), number, F.lit(f"].{name}"))


@dataclass(frozen=True)
class Rules:
    """Parameters of the contract and the rule sets built from them."""

    required: tuple[str, ...] = REQUIRED
    required_parts: tuple[str, ...] = REQUIRED_PARTS
    tolerance: float = 0.01

    def sets(self) -> dict[str, RuleSet]:
        return {
            "required": self.required_values,
            "pattern": self.patterns,
            "negative": self.negatives,
            "line_seq": self.line_sequence,
            "line_total": self.line_totals,
            "subtotal": self.subtotal,
            "cardinality": self.cardinality,
        }

    def required_values(self) -> Column:
        nulls = [
            _violation(_header(f).isNull(), "required", f, F.lit(None)) for f in self.required
        ]
        for field in self.required_parts:
            struct = field.split(".")[0]
            # A missing struct is reported once, not once per part.
            nulls.append(
                _violation(
                    _header(struct).isNotNull() & _header(field).isNull(), "required", field, F.lit(None)
                )
            )
        blanks = [
            _violation(F.trim(_header(f)) == "", "not_blank", f, _header(f)) for f in NOT_BLANK
        ] + [_violation(F.trim("flags") == "", "not_blank", "flags", F.col("flags"))]
        in_lines = _per_line(
            lambda x: [
                _violation(F.trim(x[n]) == "", "not_blank", _line_field(x, n), x[n]) for n in NOT_BLANK_IN_LINES
            ]
        )
        codes = F.coalesce(
            F.transform(
                F.filter("barcodes", lambda b: F.trim(b) == ""),
                lambda b: _violation(F.lit(True), "not_blank", "barcodes", b),
            ),
            F.array(),
        )
        return F.concat(_found(*nulls, *blanks), in_lines, codes)

    def patterns(self) -> Column:
        codes = [
            _violation(~_header(f).rlike(p), "pattern", f, _header(f)) for f, p in PATTERNS.items()
        ]
        dates = [
            _violation(
                ~_header(f).rlike(ISO) | F.try_to_date(_header(f), "yyyy-MM-dd").isNull(),
                "iso_date",
                f,
                _header(f),
            )
            for f in HEADER_DATES
        ]
        # A NULL date is a matter of the required rule.
        dates = [F.when(_header(f).isNotNull(), d) for f, d in zip(HEADER_DATES, dates)]
        return _found(*codes, *dates)

    def negatives(self) -> Column:
        header = [_violation(_header(f) < 0, "not_negative", f, _header(f)) for f in NOT_NEGATIVE]
        in_lines = _per_line(
            lambda x: [
                _violation(x[n] < 0, "not_negative", _line_field(x, n), x[n]) for n in NOT_NEGATIVE_IN_LINES
            ]
        )
        return F.concat(_found(*header), in_lines)

    def line_sequence(self) -> Column:
        numbers = F.transform("line_items", lambda x: x["lineNumber"])
        # sequence(1, 0) would count down, so lists without lines are left out.
        wanted = F.when(F.size("line_items") > 0, F.sequence(F.lit(1), F.size("line_items")))
        broken = ~numbers.eqNullSafe(wanted) & wanted.isNotNull()
        return _found(_violation(broken, "line_sequence", "lineItems.lineNumber", F.array_join(numbers, ",", "null")))

    def line_totals(self) -> Column:
        off = lambda x: F.abs(x["lineTotal"] - x["quantityShipped"] * x["unitPrice"]) > self.tolerance
        return _per_line(lambda x: [_violation(off(x), "line_total", _line_field(x, "lineTotal"), x["lineTotal"])])

    def subtotal(self) -> Column:
        total = F.aggregate(
            "line_items", F.lit(0.0), lambda acc, x: acc + F.coalesce(x["lineTotal"], F.lit(0.0))
        )
        off = F.abs(_header("subtotalAmount") - total) > self.tolerance
        return _found(_violation(off, "subtotal", "subtotalAmount", _header("subtotalAmount")))

    def cardinality(self) -> Column:
        no_lines = F.coalesce(F.size("line_items"), F.lit(0)) == 0
        repeated = F.size(F.array_distinct("barcodes")) != F.size("barcodes")
        return _found(
            _violation(no_lines, "min_items", "lineItems", F.lit(0)),
            _violation(repeated, "unique", "barcodes", F.array_join("barcodes", ",", "null")),
        )


def validate(
    records: DataFrame,
    rule_sets: Iterable[str] | None = None,
    rules: Rules = Rules(),
    key: str = "source_file_path",
) -> DataFrame:
    """(key, rule, field, value): one row per broken rule of a nested record."""
    sets = rules.sets()
    chosen = list(sets) if rule_sets is None else list(rule_sets)
    arrays = [sets[name]() for name in chosen]
    found = F.concat(*arrays) if len(arrays) > 1 else arrays[0]
    return unnest(records.select(key, found.alias("_found")), "_found", [key])


def _node(v: Column, path: str) -> Column:
    """The value at a path, JSON null included; NULL when there is no such key."""
    return F.try_variant_get(v, path, "variant")


def _payload_lines(check: Callable[[Column, Column], list[Column]]) -> Column:
    """Violations of the elements of ``lineItems``, which are known by their place."""
    items = F.try_variant_get("response", "$.lineItems", "array<variant>")
    return F.coalesce(F.flatten(F.transform(items, lambda x, i: _found(*check(x, i)))), F.array())


def _placed(i: Column, name: str = "") -> Column:
    return F.concat(F.lit("lineItems["), i.cast("string"), F.lit(f"]{name and '.'}{name}"))


def validate_payload_keys(
    responses: DataFrame, keys: Iterable[str] | None = None, key: str = "source_file_path"
) -> DataFrame:
    """(key, rule, field, value) for names that the payload does not have at all.

    Without ``keys`` (header names) the whole contract is checked: parts at the top, header
    names, the parts of objects in the header, and the names of every line item.
    """
    v = F.col("response")
    header = INVOICE_HEADER.fieldNames() if keys is None else list(keys)
    missing = [_violation(_node(v, f"$.invoiceHeader.{n}").isNull(), "key_present", n, F.lit(None)) for n in header]
    lines = F.array().cast(VIOLATIONS)
    if keys is None:
        missing += [_violation(_node(v, f"$.{n}").isNull(), "key_present", n, F.lit(None)) for n in TOP_LEVEL]
        for f in INVOICE_HEADER.fields:
            if isinstance(f.dataType, T.StructType):
                known = F.schema_of_variant(_node(v, f"$.invoiceHeader.{f.name}")).startswith("OBJECT")
                missing += [
                    _violation(known & _node(v, f"$.invoiceHeader.{f.name}.{p}").isNull(), "key_present", f"{f.name}.{p}", F.lit(None))
                    for p in f.dataType.fieldNames()
                ]
        lines = _payload_lines(
            lambda x, i: [_violation(_node(x, f"$.{n}").isNull(), "key_present", _placed(i, n), F.lit(None)) for n in LINE_ITEM.fieldNames()]
        )
    parsed = responses.filter(v.isNotNull())
    return unnest(parsed.select(key, F.concat(_found(*missing), lines).alias("_found")), "_found", [key])


def _nodes(schema: T.StructType) -> str:
    return T.StructType([T.StructField(f.name, T.VariantType()) for f in schema.fields]).simpleString()


def _integers(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.DoubleType()) for f in schema.fields if f.dataType == T.IntegerType()])


def _read_fields(v: Column, path: str, schema: T.StructType, nodes: bool = True) -> list[Column]:
    """The fields of an object as their kinds, integers also as doubles, and (``nodes``) as they are; a pass over the value each."""
    integers = _integers(schema)
    kinds = {"typed": schema.simpleString(), "doubles": integers.simpleString()} | ({"nodes": _nodes(schema)} if nodes else {})
    return [F.try_variant_get(v, path, kind).alias(name) for name, kind in kinds.items() if name != "doubles" or len(integers)]


def _doubtful(read: Column, schema: T.StructType) -> Column:
    """Whether a field of a read object is missing, or an integer that is none."""
    out = F.lit(False)
    for f in schema.fields:
        value = read["typed"][f.name]
        out = out | (value.isNull() if f.dataType != T.IntegerType() else ~value.cast("double").eqNullSafe(read["doubles"][f.name]) | value.isNull())
    return out


def _read_object(v: Column, path: str, schema: T.StructType) -> Column:
    return F.struct(*_read_fields(v, path, schema))


def _lost(node: Column, value: Column) -> Column:
    return node.isNotNull() & ~F.is_variant_null(node) & value.isNull()


def _wrong_kinds(read: Column, schema: T.StructType, name: Callable[[str], Column]) -> list[Column]:
    """A violation for each field of a read object that holds a value of another kind."""
    out = []
    for f in schema.fields:
        node, value = read["nodes"][f.name], read["typed"][f.name]
        bad = _lost(node, value)
        if f.dataType == T.IntegerType():
            bad = bad | (node.isNotNull() & ~F.is_variant_null(node) & (read["doubles"][f.name] != value))
        out.append(_violation(bad, "kind", name(f.name), F.to_json(node)))
    return out


def validate_payload_values(responses: DataFrame, key: str = "source_file_path") -> DataFrame:
    """(key, rule, field, value) for values of the wrong kind, which records hold as NULL."""
    v = F.col("response")
    header = _read_object(v, "$.invoiceHeader", INVOICE_HEADER)
    found = _wrong_kinds(F.col("_header"), INVOICE_HEADER, lambda n: F.lit(n))
    inner = [f for f in INVOICE_HEADER.fields if isinstance(f.dataType, T.StructType)]
    parts = {f.name: _read_object(v, f"$.invoiceHeader.{f.name}", f.dataType) for f in inner}
    for f in inner:
        found += _wrong_kinds(F.col(f"_parts.{f.name}"), f.dataType, lambda n, outer=f.name: F.lit(f"{outer}.{n}"))
    items = F.try_variant_get(v, "$.lineItems", "array<variant>")
    # Every element is read once, before its fields are judged; those in order need no look at the fields as they are.
    read = F.transform(items, lambda x: F.struct(x.alias("whole"), *_read_fields(x, "$", LINE_ITEM, nodes=False)))

    def judged(x: Column, i: Column) -> Column:
        full = F.array(F.struct(F.try_variant_get(x["whole"], "$", _nodes(LINE_ITEM)).alias("nodes"), x["typed"].alias("typed"), x["doubles"].alias("doubles")))
        found = F.flatten(F.transform(full, lambda y: _found(*_wrong_kinds(y, LINE_ITEM, lambda n: _placed(i, n)))))
        whole = _violation(_lost(x["whole"], x["typed"]), "kind", _placed(i), F.to_json(x["whole"]))
        return F.when(_doubtful(x, LINE_ITEM), F.concat(_found(whole), found)).otherwise(F.array().cast(VIOLATIONS))

    # Typed arrays tell whether any element needs that look at all.
    typed = {"typed": LINE_ITEM, "doubles": _integers(LINE_ITEM)}
    typed = {name: F.try_variant_get(v, "$.lineItems", f"array<{kind.simpleString()}>") for name, kind in typed.items()}
    doubtful = F.exists(F.arrays_zip(*[c.alias(name) for name, c in typed.items()]), lambda x: _doubtful(x, LINE_ITEM))
    lines = F.when(doubtful, F.transform(read, judged))
    parsed = responses.filter(v.isNotNull())
    # A generator between the projections keeps them from being merged and values from being read once for each use.
    once = pin(parsed.select(key, header.alias("_header"), F.struct(*[c.alias(n) for n, c in parts.items()]).alias("_parts"), F.coalesce(F.flatten(lines), F.array()).alias("_lines")), "_header", "_parts", "_lines")
    return unnest(once.select(key, F.concat(_found(*found), F.col("_lines")).alias("_found")), "_found", [key])


def violation_summary(violations: DataFrame) -> DataFrame:
    """(rule, field, n). Line positions are dropped from field names first."""
    field = F.regexp_replace("field", r"\[[^\]]*\]", "")
    return violations.groupBy("rule", field.alias("field")).agg(F.count("*").alias("n"))
