"""The flow contract as one Spark plan: raw JSON text -> VARIANT -> violations in field order -> bronze rows or quarantine.

Types are strict: text is no number, a boolean no count. Unknown fields are ignored. The rules over several fields run only
on records whose fields are all right, and the first that fails is told.

Most records have the right fields, with or without unknown ones among them. A pattern over a record's schema tells so, and plain
comparisons of its typed fields do the rest; only the others are taken apart field by field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netquarry.functions.network import normalized_ip, record_id
from netquarry.schemas import BRONZE, EVIDENCE_LIMIT, MESSAGE_LIMIT, QUARANTINE

COUNT = (0, 2**63 - 1)
# The keys are fixed values: the error types.
MESSAGES = {
    "missing": "the field is missing", "int_type": "not a whole number", "float_type": "not a number", "string_type": "not a text",
    "bool_type": "neither true nor false", "list_type": "not a list", "model_type": "not an object", "dict_type": "not an object",
    "greater_than_equal": "below the least allowed value", "less_than_equal": "above the largest allowed value", "finite_number": "not finite",
    "string_too_short": "an empty text", "literal_error": "not one of the allowed values", "invalid_ip_address": "no address of IPv4 or IPv6",
    "missing_event_time": "both first_seen and last_seen must be there", "time_reversed": "last_seen comes before first_seen",
    "totals_mismatch": "the directions don't add up to the total", "ip_version_mismatch": "an address isn't of the version that ip_version tells",
}

TIMESTAMP = [("unix_seconds", "int", (0, 253_402_300_799)), ("nanos", "int", (0, 999_999_999)), ("rfc3339", "text", 1)]
ENDPOINT = [("ip", "ip", None), ("port", "int", (0, 65_535))]
DIRECTION = [("packets", "int", COUNT), ("bytes", "int", COUNT), ("payload_bytes", "int", COUNT)]
SIZES = [(n, "float", None) for n in ("min", "max", "mean", "stddev", "median")] + [("median_exact", "bool", None)]
GAPS = [(n, "float", None) for n in ("min_seconds", "max_seconds", "mean_seconds", "stddev_seconds")]
TCP = [("state", "text", 1), ("flags_initiator", "texts", 1), ("flags_responder", "texts", 1)] + [(n, "int", COUNT) for n in ("syn_packets", "fin_packets", "rst_packets", "duplicate_segments")]
APPLICATION = [("protocols", "texts?", 1)] + [(n, "texts?", 0) for n in ("dns_queries", "responder_dns_names", "http_hosts", "http_paths", "tls_server_names", "tls_alpn")]
#: Name, kind and bounds or parts, in field order. A `|` after the kind allows null, a `?` allows absence.
FLOW = [
    ("flow_id", "int", (1, COUNT[1])), ("ip_version", "one_of", (4, 6)), ("protocol", "int", (0, 255)), ("protocol_name", "text|", 0), ("initiator", "object", ENDPOINT), ("responder", "object", ENDPOINT),
    ("initiator_basis", "text", 1), ("first_seen", "object|", TIMESTAMP), ("last_seen", "object|", TIMESTAMP), ("duration_seconds", "float", None), ("first_packet_index", "int", COUNT),
    ("last_packet_index", "int", COUNT), ("initiator_to_responder", "object", DIRECTION), ("responder_to_initiator", "object", DIRECTION), ("packets_total", "int", (1, COUNT[1])), ("bytes_total", "int", COUNT),
    ("packet_size", "object|", SIZES), ("inter_arrival", "object|", GAPS), ("tcp", "object|", TCP), ("application", "object", APPLICATION), ("dominant_endpoint", "text", 1), ("end_reason", "text", 1),
    ("warnings", "warnings?", None), ("alert_ids", "counts?", None),
]
WARNING = [("code", "text", 1), ("count", "int", COUNT)]
ENVELOPE = [("contract_version", "one_of", (1,)), ("sensor_id", "text", 1), ("capture_id", "text", 1), ("capture_file", "text|?", 0), ("completion_state", "text", 1), ("flow", "dict", [])]
_NOT_FINITE = "__not_finite__"
#: All up to a bare NaN or Infinity outside texts; possessive, so that long texts need no stack.
_BARE = r'\G((?:[^"NI-]++|"(?:[^"\\]++|\\.)*+"|-(?!Infinity))*+)(-?Infinity|NaN)'
#: The largest finite double.
_LARGEST = 1.7976931348623157e308


def marked(raw: Column, mark: str) -> Column:
    """raw with each bare NaN or Infinity, which are no JSON, as a text: `mark`, which may name them as $2."""
    return F.regexp_replace(raw, _BARE, f'$1"{mark}"')


def parsed(raw: Column) -> Column:
    """VARIANT of a JSON text. Bare NaN and Infinity are kept as a marked text; what is JSON already is left alone."""
    return F.coalesce(F.try_parse_json(raw), F.try_parse_json(marked(raw, _NOT_FINITE)))


def _split(spec: list):
    """(name, kind, nullable, optional, bound) of each field."""
    return [(name, kind.rstrip("|?"), "|" in kind, "?" in kind, bound) for name, kind, bound in spec]


# ---------------------------------------------------------------- records with the right fields

_TYPED = {"int": "bigint", "one_of": "bigint", "float": "double", "bool": "boolean", "text": "string", "ip": "string", "texts": "array<string>", "counts": "array<bigint>", "warnings": "array<struct<code:string,count:bigint>>"}
_SHAPES = {
    "int": "BIGINT", "one_of": "BIGINT", "float": r"(?:BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))", "bool": "BOOLEAN", "text": "STRING", "ip": "STRING", "texts": "ARRAY<(?:STRING|VOID)>",
    "counts": "ARRAY<(?:BIGINT|VOID)>", "warnings": "ARRAY<(?:VOID|OBJECT<code: STRING, count: BIGINT>)>",
}


def typed(spec: list) -> str:
    """The struct type of a spec's records."""
    return "struct<" + ",".join(f"{name}:{typed(bound) if kind == 'object' else _TYPED[kind]}" for name, kind, _, _, bound in _split(spec)) + ">"


#: A field name in the text of a schema, and the type of a value of at most three levels.
_NAME = r"(?:[A-Za-z0-9_]++|`(?:[^`]|``)*+`)"
_ANY = r"[A-Z]++(?:\(\d++,\d++\))?"
for _ in range(3):
    _ANY = rf"(?:OBJECT<(?:{_NAME}: {_ANY}(?:, |(?=>)))*+>|ARRAY<{_ANY}>|[A-Z]++(?:\(\d++,\d++\))?)"


def shape(spec: list, tolerant: bool = False) -> str:
    """A pattern of the schemas of records with all fields of the right type; fields come by name.

    tolerant: other fields may stand between them, of up to three levels each; what is deeper is judged field by field.
    """
    known = "|".join(name for name, *_ in spec)
    other = rf"(?:(?!(?:{known}): ){_NAME}: {_ANY}(?:, |(?=>)))*+" if tolerant else ""
    out = [other]
    for name, kind, nullable, optional, bound in sorted(_split(spec)):
        if kind == "object":
            one = shape(bound, tolerant)
        elif kind == "warnings" and tolerant:
            one = f"ARRAY<(?:VOID|{shape(WARNING, tolerant)})>"
        else:
            one = _SHAPES[kind]
        field = f"{name}: {f'(?:VOID|{one})' if nullable else one}(?:, |(?=>))"
        out.append((f"(?:{field})?" if optional else field) + other)
    return f"OBJECT<{''.join(out)}>"


def _lists_right(at: Column, spec: list) -> Column:
    """Whether the items of all lists of a typed record are right."""
    item = {
        "texts": lambda least: lambda x: F.coalesce(F.length(x) >= least, F.lit(False)),
        "counts": lambda _: lambda x: F.coalesce(x >= 0, F.lit(False)),
        "warnings": lambda _: lambda x: F.coalesce((F.length(x["code"]) > 0) & (x["count"] >= 0), F.lit(False)),
    }
    every = F.lit(True)
    for name, kind, _, _, bound in _split(spec):
        if kind == "object":
            every = every & _lists_right(at[name], bound)
        elif kind in item:
            every = every & (at[name].isNull() | (F.size(at[name]) == 0) | F.forall(at[name], item[kind](bound)))
    return every


def _bound_errors(at: str, spec: list, path: str = "") -> dict[str, str]:
    """SQL of the error type or null for each field of a typed record that has bounds, by location, in order. What is null has none."""
    out = {}
    for name, kind, _, _, bound in _split(spec):
        c, loc = f"{at}.{name}", f"{path}.{name}" if path else name
        if kind == "object":
            out |= _bound_errors(c, bound, loc)
        elif kind == "int":
            out[loc] = f"CASE WHEN {c} < {bound[0]}L THEN 'greater_than_equal' WHEN {c} > {bound[1]}L THEN 'less_than_equal' END"
        elif kind == "one_of":
            out[loc] = f"CASE WHEN {c} NOT IN ({', '.join(map(str, bound))}) THEN 'literal_error' END"
        elif kind == "float":
            out[loc] = f"CASE WHEN abs({c}) > {_LARGEST!r}D THEN 'finite_number' WHEN {c} < 0 THEN 'greater_than_equal' END"
        elif kind == "ip":
            out[loc] = f"CASE WHEN __ip_{at.split('.')[-1]} IS NULL THEN 'invalid_ip_address' END"
        elif kind == "text" and bound:
            out[loc] = f"CASE WHEN length({c}) < {bound} THEN 'string_too_short' END"
    return out


def _disagreement(s: Column) -> Column:
    """The type of the first rule over several fields that a typed record fails."""
    when = lambda name: F.struct(s[name]["unix_seconds"], s[name]["nanos"])
    differs = lambda what: ~F.try_add(s["initiator_to_responder"][what], s["responder_to_initiator"][what]).eqNullSafe(s[f"{what}_total"])
    other = lambda x: F.when(F.contains(F.col(f"__ip_{x}"), F.lit(":")), 6).otherwise(4) != s["ip_version"]
    return (
        F.when(s["first_seen"].isNull() | s["last_seen"].isNull(), "missing_event_time").when(when("last_seen") < when("first_seen"), "time_reversed").when(differs("packets") | differs("bytes"), "totals_mismatch")
        .when(other("initiator") | other("responder"), "ip_version_mismatch")
    )


# ---------------------------------------------------------------- the others, field by field


def _type_of(loc: str) -> str:
    return "__t_" + loc.replace(".", "_")


def _locations(spec: list, path: str = "") -> list[str]:
    out = []
    for name, kind, _, _, bound in _split(spec):
        loc = f"{path}.{name}" if path else name
        out += [loc, *(_locations(bound, loc) if kind == "object" else [])]
    return out


_OBJECT = _type_of("")


def _is_object(root: str, path: str) -> str:
    """SQL of whether there is an object; its fields are not read."""
    return f"(try_variant_get({root}, '{path}', 'map<string,variant>') IS NOT NULL)"


def with_types(df: DataFrame, root: str, spec: list, only: str | None = None) -> DataFrame:
    """df with the schema of each field in a column of its own, each computed once, and whether the whole is an object; only: where they are needed.

    Of a record with a `dict`, which is judged by itself, neither that nor the whole is read to its last value.
    """
    found = {_OBJECT: f"coalesce(schema_of_variant({root}) LIKE 'OBJECT%', false)"} | {_type_of(x): f"schema_of_variant(variant_get({root}, '$.{x}', 'variant'))" for x in _locations(spec)}
    for name in (x for x, kind, *_ in spec if kind == "dict"):
        found[_OBJECT] = _is_object(root, "$")
        found[_type_of(name)] = f"CASE WHEN {_is_object(root, f'$.{name}')} THEN 'OBJECT' WHEN variant_get({root}, '$.{name}', 'variant') IS NOT NULL THEN 'other' END"
    return df.selectExpr("*", *[f"{c} AS {k}" if only is None else f"CASE WHEN {only} THEN {c} END AS {k}" for k, c in found.items()])


_BEYOND = "'^DECIMAL[(](19|[23][0-9]),0[)]$'"  # the schema of a whole number beyond BIGINT; 1.0 is a shorter one


def _rules(root: str, path: str, spec: list, guard: str | None) -> list[tuple[str, str]]:
    """SQL of (location, error type or null) of each rule under `path`, in order; guard: the parents are objects. Needs with_types().

    Text, as one parse of it is far quicker than the thousands of calls that build the same from columns.
    """
    out = []
    for name, kind, nullable, optional, bound in _split(spec):
        loc = f"{path}.{name}" if path else name
        t = _type_of(loc)
        value = lambda as_, loc=loc: f"try_variant_get({root}, '$.{loc}', '{as_}')"
        text = value("string")
        if kind == "int":
            n, minus, beyond = value("bigint"), f"startswith({text}, '-')", f"{t} RLIKE {_BEYOND}"
            bad = (
                f"CASE WHEN {t} <> 'BIGINT' AND NOT {beyond} THEN 'int_type' WHEN CASE WHEN {beyond} THEN {minus} ELSE {n} < {bound[0]}L END THEN 'greater_than_equal' "
                f"WHEN CASE WHEN {beyond} THEN NOT {minus} ELSE {n} > {bound[1]}L END THEN 'less_than_equal' END"
            )
        elif kind == "one_of":
            bad = f"CASE WHEN {t} <> 'BIGINT' OR {value('bigint')} NOT IN ({', '.join(map(str, bound))}) THEN 'literal_error' END"
        elif kind == "float":
            n = value("double")
            bad = (
                f"CASE WHEN {t} = 'STRING' AND {text} = '{_NOT_FINITE}' THEN 'finite_number' WHEN NOT {t} RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)' THEN 'float_type' "
                f"WHEN abs({n}) > {_LARGEST!r}D THEN 'finite_number' WHEN {n} < 0 THEN 'greater_than_equal' END"
            )
        elif kind == "bool":
            bad = f"CASE WHEN {t} <> 'BOOLEAN' THEN 'bool_type' END"
        elif kind in ("text", "ip"):
            rest = f"length({text}) < {bound or 0} THEN 'string_too_short'" if kind == "text" else f"__ip_{loc.split('.')[0]} IS NULL THEN 'invalid_ip_address'"
            bad = f"CASE WHEN {t} <> 'STRING' OR {text} = '{_NOT_FINITE}' THEN 'string_type' WHEN {rest} END"
        elif kind in ("object", "dict"):
            bad = f"CASE WHEN NOT startswith({t}, 'OBJECT') THEN '{'dict_type' if kind == 'dict' else 'model_type'}' END"
        else:
            bad = f"CASE WHEN NOT startswith({t}, 'ARRAY') THEN 'list_type' END"
        if nullable:
            bad = f"CASE WHEN {t} <> 'VOID' THEN {bad} END"
        bad = f"CASE WHEN {t} IS NULL THEN {'NULL' if optional else repr('missing')} ELSE {bad} END"
        out.append((f"'{loc}'", bad if guard is None else f"CASE WHEN {guard} THEN {bad} END"))
        inside = lambda what, t=t: f"startswith({t}, '{what}')" if guard is None else f"{guard} AND startswith({t}, '{what}')"
        if kind == "object":
            out += _rules(root, loc, bound, inside("OBJECT"))
        elif kind in ("texts", "counts", "warnings"):
            first = f"CASE WHEN {inside('ARRAY')} THEN {_first_item(root, loc, kind, bound)} END"
            out.append((f"({first}).loc", f"({first}).type"))
    return out


def _first_item(root: str, loc: str, kind: str, least: int | None) -> str:
    """SQL of the first bad item of a list: a struct of its place and error type."""
    items = f"try_variant_get({root}, '$.{loc}', 'array<variant>')"
    text = f"CASE WHEN coalesce(schema_of_variant(x), 'VOID') <> 'STRING' THEN 'string_type' WHEN length(try_variant_get(x, '$', 'string')) < {least or 0} THEN 'string_too_short' END"
    count = lambda x: f"CASE WHEN schema_of_variant({x}) RLIKE {_BEYOND} THEN 'less_than_equal' WHEN coalesce(schema_of_variant({x}), 'VOID') <> 'BIGINT' THEN 'int_type' WHEN try_variant_get({x}, '$', 'bigint') < 0 THEN 'greater_than_equal' END"
    if kind == "texts":
        rule, tail = text, "''"
    elif kind == "counts":
        rule, tail = count("x"), "''"
    else:
        code, n = "variant_get(x, '$.code', 'variant')", "variant_get(x, '$.count', 'variant')"
        code_rule = f"CASE WHEN {code} IS NULL THEN 'missing' WHEN schema_of_variant({code}) <> 'STRING' THEN 'string_type' WHEN length(try_variant_get(x, '$.code', 'string')) < 1 THEN 'string_too_short' END"
        rule = f"CASE WHEN coalesce(schema_of_variant(x), 'VOID') NOT LIKE 'OBJECT%' THEN 'model_type' ELSE coalesce({code_rule}, CASE WHEN {n} IS NULL THEN 'missing' ELSE {count(n)} END) END"
        tail = f"CASE WHEN coalesce(schema_of_variant(x), 'VOID') NOT LIKE 'OBJECT%' THEN '' WHEN ({code_rule}) IS NOT NULL THEN '.code' ELSE '.count' END"
    return f"get(filter(transform({items}, (x, i) -> named_struct('loc', concat('{loc}.', i, {tail}), 'type', {rule})), e -> e.type IS NOT NULL), 0)"


def with_violations(df: DataFrame, root: str, spec: list, name: str) -> DataFrame:
    """df with its violations as `name`: array<struct<loc, type>> in field order. Needs with_types().

    The error of each rule is a column first: what is inside an array's function would be computed as often as it is used.
    """
    rules = {f"__e_{k}": x for k, x in enumerate(_rules(root, "", spec, _OBJECT))}
    # a list tells the place of its first bad item itself
    judged = df.selectExpr("*", *[f"{bad.removesuffix('.type') if loc.endswith('.loc') else bad} AS {k}" for k, (loc, bad) in rules.items()])
    told = [F.col(k) if loc.endswith(".loc") else F.when(F.col(k).isNotNull(), F.struct(F.expr(loc).alias("loc"), F.col(k).alias("type"))) for k, (loc, _) in rules.items()]
    return judged.withColumn(name, F.array_compact(F.array(_not_object(), *told))).drop(*rules)


def _not_object() -> Column:
    return F.when(~F.col(_OBJECT), F.struct(F.lit("<record>").alias("loc"), F.lit("model_type").alias("type")))


def _time(name: str) -> Column:
    return F.struct(F.expr(f"try_variant_get(v, '$.{name}.unix_seconds', 'bigint')"), F.expr(f"try_variant_get(v, '$.{name}.nanos', 'bigint')"))


def cross_rules() -> Column:
    """The first rule over several fields that fails, as struct(loc, type)."""
    n = lambda path: F.expr(f"try_variant_get(v, '$.{path}', 'decimal(38,0)')")
    present = [F.expr(f"schema_of_variant(variant_get(v, '$.{x}', 'variant'))").startswith("OBJECT") for x in ("first_seen", "last_seen")]
    total = lambda what: n(f"{what}_total") != n(f"initiator_to_responder.{what}") + n(f"responder_to_initiator.{what}")
    version = lambda ip: F.when(F.col(ip).contains(":"), 6).otherwise(4) != n("ip_version")
    kind = (
        F.when(~(present[0] & present[1]), "missing_event_time").when(_time("last_seen") < _time("first_seen"), "time_reversed").when(total("packets") | total("bytes"), "totals_mismatch")
        .when(version("__ip_initiator") | version("__ip_responder"), "ip_version_mismatch")
    )
    return F.when(kind.isNotNull(), F.struct(F.lit("<record>").alias("loc"), kind.alias("type")))


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows over as many tasks as there are cores or shuffle partitions.

    For rows of few large row groups: a check takes far longer than the row's way through a shuffle, and a row group is one task.
    """
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def checked(raw: DataFrame) -> DataFrame:
    """raw (with `raw`: JSON text of one flow) with v, the addresses in normal form and error_type: the type of the first error.

    Flows that decode_messages has parsed with their envelopes come as `flow` and `bare`; __shaped tells those that had the right fields.
    """
    if "flow" in raw.columns:
        read = raw.withColumnsRenamed({"flow": "v", "bare": "__bare"})
        raw = raw.drop("flow", "bare")
    else:
        plain = raw.withColumn("__plain", F.try_parse_json("raw"))
        read = plain.withColumns({"v": F.coalesce("__plain", F.try_parse_json(marked(F.col("raw"), _NOT_FINITE))), "__bare": F.col("__plain").isNull()}).drop("__plain")
    read = read.withColumn("__s", F.expr(f"try_variant_get(v, '$', '{typed(FLOW)}')"))
    # a record that is no typed one as a whole may still have its addresses
    address = lambda x: normalized_ip(F.coalesce(F.col("__s")[x]["ip"], F.expr(f"try_variant_get(v, '$.{x}.ip', 'string')")))
    read = read.withColumns({f"__ip_{x}": address(x) for x in ("initiator", "responder")})
    s = F.col("__s")
    # the first pattern fails at once at a field that it doesn't know; the other reads on behind it
    schema = F.expr("schema_of_variant(v)")
    shaped = ~F.col("__bare") & (schema.rlike(f"^{shape(FLOW)}$") | schema.rlike(f"^{shape(FLOW, tolerant=True)}$")) & _lists_right(s, FLOW)
    told = with_types(read.withColumn("__shaped", F.coalesce(shaped, F.lit(False))), "v", FLOW, "NOT __shaped")
    quick = F.coalesce(F.expr(f"coalesce({', '.join(_bound_errors('__s', FLOW).values())})"), _disagreement(s))
    slow = F.coalesce(_not_object()["type"], F.expr(f"coalesce({', '.join(bad for _, bad in _rules('v', '', FLOW, None))})"), cross_rules()["type"])
    judged = told.withColumn("__error", F.when(F.col("__shaped"), quick).otherwise(slow))
    # as a generated row: a filter on error_type would else be pushed down and repeat all of the above in itself
    return judged.select(*raw.columns, "v", "__ip_initiator", "__ip_responder", "__shaped", F.inline(F.array(F.struct(F.col("__error").alias("error_type")))))


def with_messages(invalid: DataFrame) -> DataFrame:
    """Checked records with errors (array<struct<loc, type>>, in field order) and error_message, which names all of them.

    Records with the right fields can only be out of bounds, which their typed fields tell; the others are taken apart.
    """
    known = "__shaped" in invalid.columns
    told = with_violations(with_types(invalid, "v", FLOW, "NOT __shaped" if known else None), "v", FLOW, "__fields")
    every = F.when(F.size("__fields") > 0, F.col("__fields")).otherwise(F.array_compact(F.array(cross_rules())))
    if known:
        typed_ = told.withColumn("__s", F.expr(f"CASE WHEN __shaped THEN try_variant_get(v, '$', '{typed(FLOW)}') END"))
        bounds = typed_.selectExpr("*", *[f"CASE WHEN __shaped THEN {bad} END AS __b_{k}" for k, bad in enumerate(_bound_errors("__s", FLOW).values())])
        out = [F.when(F.col(f"__b_{k}").isNotNull(), F.struct(F.lit(loc).alias("loc"), F.col(f"__b_{k}").alias("type"))) for k, loc in enumerate(_bound_errors("__s", FLOW))]
        told = bounds.withColumn("__bounds", F.array_compact(F.array(*out))).withColumn("__rule", F.when(F.col("__shaped"), _disagreement(F.col("__s"))))
        rule = F.when(F.col("__rule").isNotNull(), F.struct(F.lit("<record>").alias("loc"), F.col("__rule").alias("type")))
        every = F.when(~F.col("__shaped"), every).when(F.size("__bounds") > 0, F.col("__bounds")).otherwise(F.array_compact(F.array(rule)))
        told = told.drop("__s", *[f"__b_{k}" for k in range(len(out))])
    messages = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])
    named = told.withColumn("errors", every).withColumn("error_message", summary(F.col("errors"), messages)).drop("__fields", "__bounds", "__rule", "__shaped", _OBJECT, *map(_type_of, _locations(FLOW)))
    return named.withColumn("error_message", F.coalesce("envelope_error", "error_message")) if "envelope_error" in invalid.columns else named


def summary(errors: Column, messages: Column) -> Column:
    """All errors as `loc: message`, joined by `; `, cut to MESSAGE_LIMIT characters."""
    joined = F.array_join(F.transform(errors, lambda e: F.concat(e["loc"], F.lit(": "), F.coalesce(F.try_element_at(messages, e["type"]), e["type"]))), "; ")
    return shortened(joined, MESSAGE_LIMIT)


def shortened(text: Column, limit: int) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)


def flattened(valid: DataFrame) -> DataFrame:
    """Bronze rows of checked records without errors. Context columns: batch_id, source, sensor_id, capture_id, capture_file, completion_state, ingested_at."""
    s = F.col("__s")
    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    micros = lambda x: F.timestamp_micros(s[x]["unix_seconds"] * 1_000_000 + F.expr(f"__s.{x}.nanos div 1000"))
    columns = {
        "record_id": record_id(F.col("sensor_id"), F.col("capture_id"), s["flow_id"]), "capture_completion_state": F.col("completion_state"), "contract_version": F.lit(1),
        "initiator_ip": F.col("__ip_initiator"), "responder_ip": F.col("__ip_responder"), "first_seen": micros("first_seen"), "last_seen": micros("last_seen"),
        "flow_warnings": empty(s["warnings"], "array<struct<code:string,count:bigint>>"), "upstream_alert_ids": empty(s["alert_ids"], "array<bigint>"),
        "initiator_port": s["initiator"]["port"], "responder_port": s["responder"]["port"], "app_protocols": empty(s["application"]["protocols"], "array<string>"),
    }
    for short, long in (("i2r", "initiator_to_responder"), ("r2i", "responder_to_initiator")):
        columns |= {f"{short}_{x}": s[long][x] for x, _, _ in DIRECTION}
    columns |= {f"pkt_size_{x}": s["packet_size"][x] for x, _, _ in SIZES} | {f"iat_{x}": s["inter_arrival"][x] for x, _, _ in GAPS} | {f"tcp_{x}": s["tcp"][x] for x, _, _ in TCP}
    columns |= {x: empty(s["application"][x], "array<string>") for x, _, _ in APPLICATION[1:]}
    context = {"batch_id", "source", "sensor_id", "capture_id", "capture_file", "ingested_at"}
    out = []
    for part in BRONZE.replace("array<struct<code: string, count: bigint>>", "array<struct<code:string;count:bigint>>").split(","):
        name, kind = part.split()[:2]
        source = F.col(name) if name in context else columns[name] if name in columns else s[name]
        out.append(source.cast(kind.replace(";", ",")).alias(name))
    return valid.withColumn("__s", F.expr(f"try_variant_get(v, '$', '{typed(FLOW)}')")).select(*out)


def quarantined(invalid: DataFrame) -> DataFrame:
    names = [x.split()[0] for x in QUARANTINE.split(", ")]
    return with_messages(invalid).withColumn("raw_record", shortened(F.coalesce("raw", F.to_json("v")), EVIDENCE_LIMIT)).select(*names)


def validate(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bronze rows, quarantine rows) of raw flows: raw, record_index and the context columns. Store checked() once if both are written."""
    told = checked(raw)
    return flattened(told.where("error_type is null")), quarantined(told.where("error_type is not null"))


def decode_messages(messages: DataFrame, as_text: bool = True) -> DataFrame:
    """Stream messages (value: JSON text or bytes) as raw flows with context; envelope_error is set for bad envelopes.

    Without as_text a flow isn't written as text and parsed again: raw is null for right envelopes, `flow` has the parsed flow
    and `bare` tells whether the message had a bare NaN or Infinity.
    """
    value = F.col("value").cast("string")
    text = F.when(F.expr("is_valid_utf8(CAST(value AS BINARY))"), F.col("__text"))
    plain = messages.withColumn("__text", value).withColumn("__plain", F.try_parse_json(text))
    read = plain.withColumns({"e": F.coalesce("__plain", F.try_parse_json(marked(text, _NOT_FINITE))), "__bare": F.col("__plain").isNull()})
    told = with_violations(with_types(read, "e", ENVELOPE), "e", ENVELOPE, "__errors")
    sensor = F.expr("CASE WHEN schema_of_variant(variant_get(e, '$.sensor_id', 'variant')) = 'STRING' THEN nullif(try_variant_get(e, '$.sensor_id', 'string'), '') END")
    g = lambda x: F.expr(f"try_variant_get(e, '$.{x}', 'string')")
    kind = F.when(F.col("e").isNull(), "invalid_json").when(F.size("__errors") > 0, F.concat(F.lit("envelope_"), F.get("__errors", F.lit(0)).getField("type")))
    told = told.withColumn("__kind", kind)
    kind, flow = F.col("__kind"), F.expr("variant_get(e, '$.flow', 'variant')")
    given = [F.when(kind.isNotNull(), F.col("__text")).alias("raw"), F.when(kind.isNull(), flow).alias("flow"), F.col("__bare").alias("bare")]
    if as_text:
        given = [F.when(kind.isNull(), F.to_json(flow)).otherwise(F.col("__text")).alias("raw")]
    return told.select(
        *messages.columns, F.coalesce(sensor, F.lit("unknown")).alias("sensor_id"), g("capture_id").alias("capture_id"), g("capture_file").alias("capture_file"), g("completion_state").alias("completion_state"),
        *given, kind.alias("envelope_error"),
    )
