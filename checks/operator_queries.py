"""Queries of single operators over whole tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.queries import register
from checks.records import ENC, FLAT_SQL, TS, P, key, records, source
from clinflat.functions import codes, temporal, text
from clinflat.functions.collections import Path, iif, implies, reference_key, xor
from clinflat.operators.descent import descendants, nested_schema
from clinflat.operators.flatten import Col, Constant, FlatView, Node, Select
from clinflat.sources.resources import (
    bundle_resources,
    changed_since,
    explode_bundles,
    latest_update,
    reference_index,
    resolve_conditional_refs,
    resolve_references,
)

# -- views over orders with a few nested parts ---------------------------------------------

ORDER_PARTS = {
    "resourceType": "'Order'",
    "id": "cast(o_orderkey as string)",
    "status": "o_orderstatus",
    "active": "case when o_orderkey % 5 <> 0 then o_orderkey % 2 = 0 end",
    "items": """case when o_orderkey % 4 > 0 then transform(sequence(1, cast(o_orderkey % 4 as int)), i -> named_struct(
        'n', cast(i as bigint), 'amount', o_totalprice + i, 'tags', transform(sequence(1, i), t -> concat('t', cast(t as string))))) end""",
    "parties": """case when o_orderkey % 3 > 0 then transform(sequence(1, cast(o_orderkey % 3 as int)), i ->
        named_struct('role', case when i = 1 then 'payer' else 'buyer' end, 'who', concat('c', cast(o_custkey + i as string)))) end""",
    "valueQuantity": "case when o_orderkey % 3 = 0 then named_struct('value', o_totalprice, 'unit', 'usd') end",
    "valueString": "case when o_orderkey % 3 = 1 then o_orderpriority end",
    "valueBoolean": "case when o_orderkey % 3 = 2 then o_orderkey % 2 = 0 end",
}
ITEMS = "(select o.*, unnest(generate_series(1, o_orderkey % 4)) as n from orders o)"
PARTIES = "(select o.*, unnest(generate_series(1, o_orderkey % 3)) as m from orders o)"
ID = "cast(o_orderkey as string) as id"
WHO = "'c' || (o_custkey + m)"
ROLE = "if(m = 1, 'payer', 'buyer')"


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return source(spark, folder, "orders").selectExpr(*[f"{e} as {n}" for n, e in ORDER_PARTS.items()])


def view(name: str, selects: list[Select], sql: str, **options) -> None:
    built = FlatView(name, "Order", selects, **options)
    register(name, lambda spark, folder: built.apply(orders(spark, folder)), sql)


def index(name: str) -> Col:
    return Col(name, lambda n: n.row_index, "integer")


IDS = Select([Col("id", "id", "id")])
view(
    "foreach",
    [IDS, Select(for_each="items", columns=[index("i"), Col("n", "n", "integer"), Col("amount", "amount", "decimal")])],
    f"select {ID}, n - 1 as i, n, o_totalprice + n as amount from {ITEMS}",
)
view(
    "foreach_or_null",
    [IDS, Select(for_each_or_null="items", columns=[index("i"), Col("n", "n", "integer")])],
    f"""select {ID}, n - 1 as i, n from {ITEMS} union all
    select {ID}, 0, null from orders where o_orderkey % 4 = 0""",
)
view(
    "sibling_selects",
    [
        IDS,
        Select(for_each="items", columns=[Col("n", "n", "integer")]),
        Select(for_each="parties", columns=[Col("role", "role"), Col("who", "who")]),
    ],
    f"select {ID}, n, {ROLE} as role, {WHO} as who from (select o.*, unnest(generate_series(1, o_orderkey % 3)) as m from {ITEMS} o)",
)
view(
    "nested_foreach",
    [
        IDS,
        Select(
            for_each="items",
            columns=[index("i"), Col("n", "n", "integer")],
            select=[Select(for_each="tags", columns=[index("j"), Col("tag", "$this")])],
        ),
    ],
    f"select {ID}, n - 1 as i, n, t - 1 as j, 't' || t as tag from (select q.*, unnest(generate_series(1, n)) as t from {ITEMS} q)",
)
view(
    "union_branches",
    [
        Select(
            [Col("id", "id", "id")],
            union_all=[
                Select(for_each="items", columns=[Col("kind", lambda n: F.lit("item")), index("i"), Col("v", lambda n: n["amount"])]),
                Select(columns=[Col("kind", lambda n: F.lit("order")), index("i"), Col("v", "status")]),
                Select(for_each="parties", columns=[Col("kind", "role"), index("i"), Col("v", "who")]),
            ],
        )
    ],
    f"""select {ID}, 'item' as kind, n - 1 as i, cast(o_totalprice + n as varchar) as v from {ITEMS} union all
    select {ID}, 'order', 0, o_orderstatus from orders union all
    select {ID}, {ROLE}, m - 1, {WHO} from {PARTIES}""",
)
view(
    "union_inside_foreach_or_null",
    [
        IDS,
        Select(
            for_each_or_null="items",
            columns=[index("i")],
            select=[Select(columns=[Col("n", "n", "integer")])],
            union_all=[
                Select(columns=[index("j"), Col("v", lambda n: n["tags"].first())]),
                Select(for_each="tags", columns=[index("j"), Col("v", "$this")]),
            ],
        ),
    ],
    f"""select {ID}, n - 1 as i, n, n - 1 as j, 't1' as v from {ITEMS} union all
    select {ID}, 0, null, 0, null from orders where o_orderkey % 4 = 0 union all
    select {ID}, n - 1, n, t - 1, 't' || t from (select q.*, unnest(generate_series(1, n)) as t from {ITEMS} q)""",
)
view(
    "where_filter",
    [Select([Col("id", "id", "id"), Col("status", "status", "code")])],
    f"""select {ID}, o_orderstatus as status from orders
    where o_orderkey % 5 <> 0 and o_orderkey % 2 = 0 and o_orderkey % 4 >= 2""",
    where=["active", lambda n: n["items"].exists(lambda x: x["n"].col == 2)],
)
view(
    "view_constants",
    [
        Select(
            [
                Col("id", "id", "id"),
                Col("same", lambda n: n["status"] == n.const("wanted"), "boolean"),
                Col("nth", lambda n: n["items"].at(n.const("position").cast("int"))["amount"], "decimal"),
                Col("system", lambda n: n.const("ucum"), "uri"),
            ]
        )
    ],
    f"""select {ID}, o_orderstatus = 'F' as same, if(o_orderkey % 4 >= 2, o_totalprice + 2, null) as nth,
    'http://unitsofmeasure.org' as system from orders""",
    constants={"wanted": Constant("code", "F"), "position": Constant("integer", 1)},
)
view(
    "choice_types",
    [
        Select(
            [
                Col("id", "id", "id"),
                Col("number", lambda n: n.of_type("value", "Quantity")["value"], "decimal"),
                Col("word", lambda n: n.of_type("value", "string")),
                Col("flag", lambda n: n.of_type("value", "boolean"), "boolean"),
                Col("flag_text", lambda n: n.of_type("value", "boolean"), "string"),
                Col("whole", lambda n: n["parties"].first(), "string"),
            ]
        )
    ],
    f"""select {ID}, if(o_orderkey % 3 = 0, o_totalprice, null) as number, if(o_orderkey % 3 = 1, o_orderpriority, null) as word,
    if(o_orderkey % 3 = 2, o_orderkey % 2 = 0, null) as flag,
    if(o_orderkey % 3 = 2, if(o_orderkey % 2 = 0, 'true', 'false'), null) as flag_text,
    if(o_orderkey % 3 > 0, '{{"role":"payer","who":"c' || (o_custkey + 1) || '"}}', null) as whole from orders""",
)


def _collection_column(spark: SparkSession, folder: str) -> DataFrame:
    tags = FlatView("tags", "Order", [Select([Col("id", "id"), Col("tags", "items.tags", collection=True)])])
    rows = tags.apply(orders(spark, folder))
    return rows.select("id", F.array_join("tags", "|").alias("tags"), F.size("tags").cast("bigint").alias("n"))


register(
    "collection_column",
    _collection_column,
    f"""select {ID}, array_to_string(l, '|') as tags, len(l) as n from (select o_orderkey, case o_orderkey % 4 when 0 then []
    when 1 then ['t1'] when 2 then ['t1', 't1', 't2'] else ['t1', 't1', 't2', 't1', 't2', 't3'] end as l from orders)""",
)


def _strict_single(spark: SparkSession, folder: str) -> DataFrame:
    """A strict column over a path that has at most one item on every record."""
    first = FlatView("first", "Order", [Select([Col("id", "id"), Col("n", lambda n: n["items"].where(lambda x: x["n"] == 1)["n"], "integer")])])
    return first.apply(orders(spark, folder))


register(
    "strict_single",
    _strict_single,
    f"select {ID}, if(o_orderkey % 4 >= 1, 1, null) as n from orders",
)


def _partial_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Birth dates, some without a day, compared with dates of either precision."""

    def born(n: Node) -> Path:
        return n["birthDate"].as_partial()

    columns = {
        "same": lambda n: born(n) == "1940-04",
        "differs": lambda n: born(n) != "1940-04",
        "before": lambda n: born(n) < "1940-04",
        "until": lambda n: born(n) <= "1940-04-10",
        "after": lambda n: born(n) > "1940-04",
        "since": lambda n: born(n) >= "1940-04-10",
        "member": lambda n: born(n).contains_item("1940-04-10"),
    }
    view = FlatView("dates", "Patient", [Select([Col("id", "id"), *[Col(k, f, "boolean") for k, f in columns.items()]])])
    return view.apply(records(spark, folder, "patient"))


register(
    "partial_dates",
    _partial_dates,
    f"""select id, if(d is null, m = '1940-04', if(m = '1940-04', null, false)) as same,
    if(d is null, m <> '1940-04', if(m = '1940-04', null, true)) as differs,
    if(d is not null and m = '1940-04', null, m < '1940-04') as before,
    if(d is null and m = '1940-04', null, coalesce(d <= date '1940-04-10', m < '1940-04')) as until,
    if(d is not null and m = '1940-04', null, m > '1940-04') as after,
    if(d is null and m = '1940-04', null, coalesce(d >= date '1940-04-10', m > '1940-04')) as since,
    if(d is null and m = '1940-04', null, coalesce(d = date '1940-04-10', false)) as member
    from (select cast(c_custkey as varchar) as id, strftime(date '1940-01-01' + cast(c_custkey % 20000 as int), '%Y-%m') as m,
      if(c_custkey % 50 <> 0, date '1940-01-01' + cast(c_custkey % 20000 as int), null) as d from customer)""",
)


def _logic(spark: SparkSession, folder: str) -> DataFrame:
    def tags(n: Node) -> Path:
        return n["items"]["tags"]

    columns = {
        "one_tag": lambda n: tags(n) == "t1",
        "other_tag": lambda n: tags(n) != "t1",
        "same_roles": lambda n: n["parties"]["role"] == n["parties"].select(lambda p: p["role"]),
        "has_t3": lambda n: tags(n).contains_item("t3"),
        "all_t1": lambda n: tags(n).all(lambda t: t == "t1"),
        "either": lambda n: n["active"].col | (n["status"] == "F"),
        "both": lambda n: n["active"].col & (n["status"] == "F"),
        "differ": lambda n: xor(n["active"], n["status"] == "F"),
        "follows": lambda n: implies(n["active"], n["status"] == "F"),
        "negated": lambda n: ~n["active"].col,
        "later": lambda n: n["status"] > "M",
        "chosen": lambda n: iif(n["active"], F.lit(True)),
        "is_text": lambda n: n["status"].is_type("string"),
    }
    chosen = FlatView("logic", "Order", [Select([Col("id", "id"), *[Col(k, f, "boolean") for k, f in columns.items()]])])
    return chosen.apply(orders(spark, folder))


register(
    "collection_logic",
    _logic,
    """select cast(k as varchar) as id, if(k % 4 = 0, null, k % 4 = 1) as one_tag, if(k % 4 = 0, null, k % 4 <> 1) as other_tag,
    if(k % 3 = 0, null, true) as same_roles, k % 4 = 3 as has_t3, k % 4 <= 1 as all_t1, a or s = 'F' as either, a and s = 'F' as both,
    a <> (s = 'F') as differ, (not a) or s = 'F' as follows, not a as negated, s > 'M' as later, if(a, true, null) as chosen, true as is_text
    from (select o_orderkey as k, o_orderstatus as s, if(o_orderkey % 5 <> 0, o_orderkey % 2 = 0, null) as a from orders)""",
)


# -- collections over whole texts ------------------------------------------------------------


def _collections(spark: SparkSession, folder: str) -> DataFrame:
    docs = source(spark, folder, "documents").select("doc_id", "lang", F.split("text", " ").alias("words"))
    w = Path(F.col("words"), T.ArrayType(T.StringType()))
    long = w.where(lambda x: F.length(x.col) > 5)
    return docs.select(
        "doc_id",
        w.count().cast("bigint").alias("n"),
        w.first().col.alias("first_word"),
        w.last().col.alias("last_word"),
        w.at(2).col.alias("third"),
        w.tail().count().cast("bigint").alias("n_tail"),
        w.skip(5).first().col.alias("sixth"),
        w.take(3).join("-").col.alias("head"),
        w.distinct().count().cast("bigint").alias("n_distinct"),
        long.count().cast("bigint").alias("n_long"),
        long.first().col.alias("first_long"),
        w.exists(lambda x: F.length(x.col) > 12).alias("has_very_long"),
        w.all(lambda x: F.length(x.col) > 1).alias("all_long"),
        w.contains_item("de").alias("has_de"),
        w.take(2).union(w.skip(1).take(2)).join("-").col.alias("merged"),
        w.where(lambda x, i: i % 2 == 0).count().cast("bigint").alias("n_even"),
        w.empty().alias("none"),
        w.where(lambda x: x == "de").or_first(w).col.alias("de_or_first"),
        w.select(lambda x: x.map(F.lower, T.StringType())).first().col.alias("quiet"),
    )


register(
    "collection_functions",
    _collections,
    """select doc_id, len(w) as n, w[1] as first_word, w[-1] as last_word, w[3] as third, len(w) - 1 as n_tail, w[6] as sixth,
    array_to_string(w[1:3], '-') as head, list_unique(w) as n_distinct, len(list_filter(w, lambda x: length(x) > 5)) as n_long,
    list_filter(w, lambda x: length(x) > 5)[1] as first_long, len(list_filter(w, lambda x: length(x) > 12)) > 0 as has_very_long,
    len(list_filter(w, lambda x: length(x) <= 1)) = 0 as all_long, list_contains(w, 'de') as has_de,
    w[1] || if(w[2] is null or w[2] = w[1], '', '-' || w[2]) || if(w[3] is null or w[3] = w[1] or w[3] = w[2], '', '-' || w[3]) as merged,
    (len(w) + 1) // 2 as n_even, false as none, if(list_contains(w, 'de'), 'de', w[1]) as de_or_first, lower(w[1]) as quiet
    from (select doc_id, string_split(text, ' ') as w from documents)""",
)


# -- text, numbers, dates, references ----------------------------------------------------------


def _text(spark: SparkSession, folder: str) -> DataFrame:
    c = source(spark, folder, "customer")
    name, n = F.col("c_name"), F.col("c_custkey")
    mixed = F.when(n % 2 == 0, n.cast("string")).when(n % 3 == 0, F.concat(n, F.lit(".5"))).otherwise(name)
    return c.select(
        "c_custkey",
        text.clean_name(F.concat(name, F.lit(" 12 "))).alias("clean"),
        text.clean_name(n.cast("string")).alias("nothing_left"),
        text.substring_from(name, 9).alias("tail"),
        text.substring_from(name, 0, 4).alias("head"),
        text.substring_from(name, 18).alias("beyond"),
        text.to_integer(mixed).alias("whole"),
        text.to_decimal(mixed).alias("fraction"),
        text.equivalent(F.concat(F.lit("  "), F.upper(name), F.lit(" x")), F.concat(name, F.lit("   X"))).alias("alike"),
        text.number_text(n.cast("double") / 4).alias("quarter"),
        text.number_text((n + 1).cast("double") * 12500000.5).alias("large"),
        text.number_text(F.col("c_acctbal")).alias("balance"),
        text.floor_mod(F.lit(0) - n, F.lit(7)).cast("bigint").alias("modulus"),
        text.strip_dots(F.concat(F.lit("a.b."), name)).alias("undotted"),
        codes.code_system(
            F.when(n % 3 == 0, codes.SNOMED).when(n % 3 == 1, codes.ICD10).otherwise(name)
        ).alias("system"),
    )


register(
    "text_functions",
    _text,
    """select c_custkey, 'Customer#' as clean, cast(null as varchar) as nothing_left, substr(c_name, 10) as tail, substr(c_name, 1, 4) as head,
    cast(null as varchar) as beyond, if(c_custkey % 2 = 0, c_custkey, null) as whole,
    case when c_custkey % 2 = 0 then cast(c_custkey as double) when c_custkey % 3 = 0 then c_custkey + 0.5 end as fraction, true as alike,
    cast(cast(c_custkey as double) / 4 as varchar) as quarter, cast(cast(c_custkey + 1 as double) * 12500000.5 as varchar) as large,
    cast(c_acctbal as varchar) as balance, ((0 - c_custkey) % 7 + 7) % 7 as modulus, 'ab' || c_name as undotted,
    case c_custkey % 3 when 0 then 'snomed-ct' when 1 then 'icd-10-cm' else c_name end as system from customer""",
)


def _dates(spark: SparkSession, folder: str) -> DataFrame:
    c = source(spark, folder, "customer").withColumn("born", F.expr(P["born"]))
    born = F.col("born")
    fixed = F.lit("1960-06-15")
    moment = F.concat(F.substr(born, F.lit(1), F.lit(7)), F.lit("-11T10:20:30+02:00"))
    price = F.when(F.col("c_custkey") % 2 == 0, F.lit("12.50")).otherwise(F.lit("7"))
    return c.select(
        "c_custkey",
        temporal.to_full_date(born).alias("day"),
        temporal.low_boundary(born, "date").alias("first_day"),
        temporal.high_boundary(born, "date").alias("last_day"),
        temporal.low_boundary(born, "dateTime").alias("first_moment"),
        temporal.high_boundary(born, "dateTime").alias("last_moment"),
        temporal.high_boundary(F.lit("10:30"), "time").alias("last_time"),
        temporal.low_boundary(price, "decimal").alias("low_price"),
        temporal.high_boundary(price, "decimal").alias("high_price"),
        temporal.compare_partial(born, fixed).alias("against_day"),
        temporal.compare_partial(F.substr(born, F.lit(1), F.lit(7)), F.lit("1960-06")).alias("against_month"),
        temporal.compare_partial(moment, F.concat(F.substr(born, F.lit(1), F.lit(7)), F.lit("-11T08:20:30Z"))).alias("instants"),
        temporal.to_local_timestamp(moment).alias("utc"),
        temporal.to_local_timestamp(F.substr(born, F.lit(1), F.lit(7))).alias("no_day"),
    )


PARTIAL = "length(born) = 7"
register(
    "date_functions",
    _dates,
    f"""select c_custkey, try_cast(born as date) as day, if({PARTIAL}, born || '-01', born) as first_day,
    if({PARTIAL}, cast(last_day(cast(born || '-01' as date)) as varchar), born) as last_day,
    if({PARTIAL}, born || '-01', born) || 'T00:00:00.000+14:00' as first_moment,
    if({PARTIAL}, cast(last_day(cast(born || '-01' as date)) as varchar), born) || 'T23:59:59.999-12:00' as last_moment,
    '10:30:59.999' as last_time, if(c_custkey % 2 = 0, 12.495, 6.5)::double as low_price, if(c_custkey % 2 = 0, 12.505, 7.5)::double as high_price,
    case when {PARTIAL} and born = '1960-06' then null when born < '1960-06-15' then -1 when born > '1960-06-15' then 1 else 0 end as against_day,
    case when born[:7] < '1960-06' then -1 when born[:7] > '1960-06' then 1 else 0 end as against_month, 0 as instants,
    cast(born[:7] || '-11 08:20:30' as timestamp) as utc, cast(null as timestamp) as no_day
    from (select c_custkey, {P["born"]} as born from customer)""",
)

REFERENCE_FORMS = """case o_orderkey % 9 when 0 then 'Patient/' || o_custkey when 1 then 'http://h.org/fhir/Patient/' || o_custkey
    when 2 then 'Patient/' || o_custkey || '/_history/3' when 3 then 'urn:uuid:' || o_custkey when 4 then '#' || o_custkey
    when 5 then 'Patient?identifier=' || o_custkey when 6 then cast(o_custkey as string) when 7 then 'Group/' || o_custkey
    else 'Patient/' || o_custkey || '/' end"""


def _reference_keys(spark: SparkSession, folder: str) -> DataFrame:
    o = source(spark, folder, "orders").withColumn("r", F.expr(REFERENCE_FORMS))
    r = F.col("r")
    return o.select("o_orderkey", reference_key(r, "Patient").alias("patient"), reference_key(r).alias("any_key"))


register(
    "reference_keys",
    _reference_keys,
    """select o_orderkey, if(o_orderkey % 9 in (0, 1, 2, 8), cast(o_custkey as varchar), null) as patient,
    if(o_orderkey % 9 in (0, 1, 2, 3, 7, 8), cast(o_custkey as varchar), null) as any_key from orders""",
)


def _choices(n: Node) -> Column:
    value = n["value"]
    return F.when(value.is_type("Quantity"), value["unit"].col).otherwise(value.col)


view(
    "choice_without_type",
    [
        Select([
            Col("id", "id"),
            Col("value", _choices),
            Col("words", lambda n: n["value"].only_type("string")),
            Col("amount", lambda n: n["value"]["value"], "decimal"),
            Col("is_flag", lambda n: n["value"].is_type("boolean"), "boolean"),
            Col("is_urgent", lambda n: n["value"] == "1-URGENT", "boolean"),
            Col("is_true", lambda n: n["value"] == True, "boolean"),  # noqa: E712
            Col("there", lambda n: n["value"].exists(), "boolean"),
        ])
    ],
    """select cast(o_orderkey as string) as id,
    case o_orderkey % 3 when 0 then 'usd' when 1 then o_orderpriority else if(o_orderkey % 2 = 0, 'true', 'false') end as value,
    if(o_orderkey % 3 = 1, o_orderpriority, null) as words, if(o_orderkey % 3 = 0, o_totalprice, null) as amount,
    o_orderkey % 3 = 2 as is_flag, o_orderkey % 3 = 1 and o_orderpriority = '1-URGENT' as is_urgent,
    o_orderkey % 3 = 2 and o_orderkey % 2 = 0 as is_true, true as there from orders""",
)


view(
    "single_values_and_patterns",
    [
        Select([
            Col("id", "id"),
            Col("one_item", lambda n: n["items"]["amount"].has_value(), "boolean"),
            Col("record", lambda n: n["items"].has_value(), "boolean"),
            Col("has_words", lambda n: n["valueString"].has_value(), "boolean"),
            Col("urgent", lambda n: n["valueString"].col.rlike("[12]-[UH]"), "boolean"),
        ])
    ],
    """select cast(o_orderkey as string) as id, o_orderkey % 4 = 1 as one_item, false as record, o_orderkey % 3 = 1 as has_words,
    if(o_orderkey % 3 = 1, regexp_matches(o_orderpriority, '[12]-[UH]'), null) as urgent from orders""",
)
PREVIEW = FlatView("preview_rows", "Order", [IDS, Select(for_each="items", columns=[Col("n", "n", "integer")])])
register(
    "preview_rows",
    lambda spark, folder: PREVIEW.apply(orders(spark, folder)).limit(20).agg(F.count(F.lit(1)).alias("rows")),
    f"select count(*) as rows from (select n from {ITEMS} limit 20)",
)


def _alike(spark: SparkSession, folder: str) -> DataFrame:
    tags = Path(F.col("tags"), T.ArrayType(T.StringType()))
    other = Path(F.col("other"), T.ArrayType(T.StringType()))
    rows = source(spark, folder, "orders").select(
        "o_orderkey",
        F.split("o_orderpriority", "-").alias("tags"),
        F.expr("""case o_orderkey % 4 when 0 then array(upper(split(o_orderpriority, '-')[1]), ' ' || split(o_orderpriority, '-')[0])
            when 1 then array(split(o_orderpriority, '-')[0], split(o_orderpriority, '-')[0])
            when 2 then split(lower(o_orderpriority), '-') end""").alias("other"),
    )
    return rows.select(
        "o_orderkey", tags.equivalent(other).alias("alike"), tags.equivalent(other, in_order=True).alias("in_order")
    )


register(
    "equivalent_collections",
    _alike,
    """select o_orderkey, o_orderkey % 4 in (0, 2) as alike, o_orderkey % 4 = 2 as in_order from orders""",
)

# -- recursive descent over part ----------------------------------------------------------------


#: Tasks per core that rows of much work each are dealt to.
TASKS_PER_CORE = 4


def dealt(df: DataFrame) -> DataFrame:
    """Narrow rows that much work follows, over all cores: a small file has few splits."""
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)


def _level(child: T.DataType) -> T.StructType:
    answer = T.StructType().add("value", T.StringType()).add("item", child)
    return (
        T.StructType()
        .add("linkId", T.StringType())
        .add("answer", T.ArrayType(answer))
        .add("item", child)
    )


def trees(spark: SparkSession, folder: str) -> DataFrame:
    """brand -> (type -> answer -> size), name; and a second top-level entry."""
    schema = T.StructType().add("item", T.ArrayType(nested_schema(_level)))
    tree = F.expr("""to_json(named_struct('item', array(
        named_struct('linkId', p_brand, 'item', array(
            named_struct('linkId', p_type, 'answer', array(named_struct('value', 'x', 'item', array(
                named_struct('linkId', cast(p_size as string)))))),
            named_struct('linkId', p_name, 'answer', null))),
        named_struct('linkId', 'end', 'item', null))))""")
    part = dealt(source(spark, folder, "part"))
    parsed = F.from_json(tree, schema, {"mode": "FAILFAST"})
    return part.select(F.lit("Tree").alias("resourceType"), key_column("p_partkey").alias("id"), parsed["item"].alias("item"))


def key_column(name: str):
    return F.col(name).cast("string")


REPEAT = FlatView(
    "repeat_tree",
    "Tree",
    [IDS, Select(repeat=["item", "answer.item"], columns=[index("i"), Col("link", "linkId")])],
)
register(
    "repeat_tree",
    lambda spark, folder: REPEAT.apply(trees(spark, folder)),
    """select cast(p_partkey as varchar) as id, unnest(range(5)) as i,
    unnest([p_brand, p_type, cast(p_size as varchar), p_name, 'end']) as link from part""",
)
REPEAT_TWICE = FlatView(
    "repeat_inside_repeat",
    "Tree",
    [
        IDS,
        Select(
            repeat=["item"],
            columns=[Col("above", "linkId")],
            select=[Select(repeat=["item", "answer.item"], columns=[Col("below", "linkId")])],
        ),
    ],
)
register(
    "repeat_inside_repeat",
    lambda spark, folder: REPEAT_TWICE.apply(trees(spark, folder)),
    """select cast(p_partkey as varchar) as id, unnest([p_brand, p_brand, p_brand, p_type]) as above,
    unnest([p_type, cast(p_size as varchar), p_name, cast(p_size as varchar)]) as below from part""",
)


def _breadth(spark: SparkSession, folder: str) -> DataFrame:
    t = trees(spark, folder)
    found = descendants(Path(None, t.schema), ["item", "answer.item"], "breadth")
    return t.select("id", found["linkId"].join(">").col.alias("links"))


register(
    "repeat_breadth_first",
    _breadth,
    """select cast(p_partkey as varchar) as id,
    concat_ws('>', p_brand, 'end', p_type, p_name, cast(p_size as varchar)) as links from part""",
)


def chains(spark: SparkSession, folder: str) -> DataFrame:
    """One record per part that nests p_size levels deep, by item and by answer.item in turn."""
    part = dealt(source(spark, folder, "part").where("p_size > 0"))

    def around(inner: Column, k: Column) -> Column:
        head = F.concat(F.lit('{"linkId":"'), k, F.lit('"'))
        own = F.concat(head, F.lit(',"item":['), inner, F.lit("]}"))
        answer = F.concat(head, F.lit(',"answer":[{"value":"v","item":['), inner, F.lit("]}]}"))
        return F.when(k % 2 == 0, own).otherwise(answer)

    inner_first = F.sequence(F.col("p_size") - 1, F.lit(1), F.lit(-1))
    levels = F.when(F.col("p_size") > 1, inner_first).otherwise(F.array().cast("array<int>"))
    leaf = F.concat(F.lit('{"linkId":"'), F.col("p_size").cast("string"), F.lit('"}'))
    tree = F.concat(F.lit('{"item":['), F.aggregate(levels, leaf, around), F.lit(',{"linkId":"end"}]}'))
    schema = T.StructType().add("item", T.ArrayType(nested_schema(_level)))
    parsed = F.from_json(tree, schema, {"mode": "FAILFAST"})
    return part.select(F.lit("Tree").alias("resourceType"), key_column("p_partkey").alias("id"), parsed["item"].alias("item"))


register(
    "repeat_any_depth",
    lambda spark, folder: REPEAT.apply(chains(spark, folder)),
    """select cast(p_partkey as varchar) as id, unnest(range(p_size + 1)) as i,
    unnest(list_append(list_transform(range(1, p_size + 1), lambda x: cast(x as varchar)), 'end')) as link
    from part where p_size > 0""",
)


def _by_expression(spark: SparkSession, folder: str) -> DataFrame:
    t = chains(spark, folder)
    steps = [lambda n: n["item"].where(lambda x: x["linkId"] != "end"), "answer.item"]
    found = descendants(Path(None, t.schema), steps, "breadth")
    return t.select("id", found["linkId"].join(">").col.alias("links"))


register(
    "repeat_by_expression",
    _by_expression,
    """select cast(p_partkey as varchar) as id, array_to_string(range(1, p_size + 1), '>') as links
    from part where p_size > 0""",
)


# -- bundles, conditional references, incremental reads -------------------------------------------


def bundles(spark: SparkSession, folder: str) -> DataFrame:
    """One bundle per order: its encounter, and for even orders a practitioner."""
    return source(spark, folder, "orders").selectExpr(
        "o_orderkey as bundle",
        f"""array_compact(array(
            named_struct('resource', to_json(named_struct('resourceType', 'Encounter', 'id', {ENC}, 'status', o_orderstatus))),
            case when o_orderkey % 3 = 0 then named_struct('resource', cast(null as string)) end,
            case when o_orderkey % 2 = 0 then named_struct('resource',
                to_json(named_struct('resourceType', 'Practitioner', 'id', cast(o_orderkey as string), 'gender', 'male'))) end)) as entry""",
    )


register(
    "bundle_entries",
    lambda spark, folder: explode_bundles(bundles(spark, folder)).select(
        "bundle", "entry_count", "entry_index", "resourceType", F.get_json_object("resource", "$.id").alias("id")
    ),
    f"""select o_orderkey as bundle, cast(1 + (o_orderkey % 3 = 0)::int + (o_orderkey % 2 = 0)::int as integer) as entry_count,
    0 as entry_index, 'Encounter' as resourceType, {ENC} as id from orders union all
    select o_orderkey, cast(2 + (o_orderkey % 3 = 0)::int as integer), 1 + (o_orderkey % 3 = 0)::int, 'Practitioner',
    cast(o_orderkey as varchar) from orders where o_orderkey % 2 = 0""",
)
register(
    "bundle_resources",
    lambda spark, folder: bundle_resources(explode_bundles(bundles(spark, folder)), "Encounter").select("id", "status"),
    f"select {ENC} as id, o_orderstatus as status from orders",
)


def _conditional(spark: SparkSession, folder: str) -> DataFrame:
    searches = source(spark, folder, "orders").select(
        "o_orderkey",
        F.expr(f"""case when o_orderkey % 4 = 3 then 'Practitioner/7'
            else 'Practitioner?identifier={codes.NPI}|' || {key("N", "o_orderkey % 120")} end""").alias("r"),
    )
    return resolve_conditional_refs(searches, "r", records(spark, folder, "practitioner"), "Practitioner")


register(
    "conditional_references",
    _conditional,
    f"""with p as ({FLAT_SQL["practitioner"]}), o as (select o_orderkey, {key("N", "o_orderkey % 120")} as npi from orders)
    select o.o_orderkey, case when o.o_orderkey % 4 = 3 then 'Practitioner/7' when p.id is not null then 'Practitioner/' || p.id
    else 'Practitioner?identifier={codes.NPI}|' || o.npi end as r from o left join p on p.npi = o.npi""",
)


def _three_types(spark: SparkSession, folder: str) -> DataFrame:
    """References to a practitioner, an organization or a patient by identifier, one without a match, and plain ones."""
    kinds = {
        "Practitioner": (records(spark, folder, "practitioner"), f"{codes.NPI}|N", 120),
        "Organization": (records(spark, folder, "organization"), f"{codes.SOURCE_SYSTEM}|", 30),
        "Patient": (records(spark, folder, "patient"), f"{codes.SOURCE_SYSTEM}|src-", 5000),
    }
    forms = " ".join(
        f"when {i} then concat('{t}?identifier={start}', cast(o_orderkey % {n} as string))"
        for i, (t, (_, start, n)) in enumerate(kinds.items())
    )
    rows = source(spark, folder, "orders").select("o_orderkey", F.expr(f"case o_orderkey % 5 {forms} when 3 then 'Patient/7' end").alias("r"))
    return resolve_references(rows, "r", reference_index({t: target for t, (target, _, _) in kinds.items()}))


register(
    "conditional_references_of_three_types",
    _three_types,
    f"""select o_orderkey, case o_orderkey % 5
        when 0 then coalesce((select 'Practitioner/' || min(id) from ({FLAT_SQL["practitioner"]}) where npi = 'N' || (o_orderkey % 120)),
            'Practitioner?identifier={codes.NPI}|N' || (o_orderkey % 120))
        when 1 then coalesce((select 'Organization/' || min(id) from ({FLAT_SQL["organization"]})
            where source_identifier = cast(o_orderkey % 30 as varchar)), 'Organization?identifier={codes.SOURCE_SYSTEM}|' || (o_orderkey % 30))
        when 2 then coalesce((select 'Patient/' || min(id) from ({FLAT_SQL["patient"]}) where source_identifier = 'src-' || (o_orderkey % 5000)),
            'Patient?identifier={codes.SOURCE_SYSTEM}|src-' || (o_orderkey % 5000))
        when 3 then 'Patient/7' end as r from orders""",
)


def updates(spark: SparkSession, folder: str) -> DataFrame:
    return source(spark, folder, "events").select(
        "event_id", F.struct(F.expr(f"case when event_id % 10 <> 0 then {TS} end").alias("lastUpdated")).alias("meta")
    )


register(
    "changed_since",
    lambda spark, folder: changed_since(updates(spark, folder), "2024-01-15T00:00:00Z").select("event_id"),
    "select event_id from events where event_id % 10 <> 0 and date_trunc('second', ts) >= timestamp '2024-01-15'",
)
register(
    "latest_update",
    lambda spark, folder: latest_update(updates(spark, folder)).select(
        F.col("transaction_time").cast("timestamp_ntz").alias("transaction_time")
    ),
    "select max(date_trunc('second', ts)) as transaction_time from events where event_id % 10 <> 0",
)
