"""Access matrix to grants, policies, merges and statuses.

Grants are kept in long form, one fact per row: (policy, role, item_type, kind, value) with kind
``permission``, ``group``, ``user`` or ``rowfilter``. Merging grants is then a distinct, and a policy
or role that holds a large share of all facts is never gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import (
    blank_to_null, list_cell, mapping_name, mapping_principal, mapping_role, permission_list, policy_name,
)
from ..session import materialize
from . import ordered

# Item types, and the access types that stand behind each permission word.
ITEM_TYPES = ("allow", "allow_exception", "deny", "deny_exception")
READ = ("select", "use", "execute", "show", "read_sysinfo")
WRITE = ("select", "insert", "update", "delete", "create", "drop", "alter", "use", "show", "grant", "revoke",
         "execute", "read", "write", "read_sysinfo", "write_sysinfo")
ALL = ("select", "insert", "update", "delete", "create", "drop", "alter", "use", "show", "grant", "revoke",
       "impersonate", "execute", "read", "write", "read_sysinfo", "write_sysinfo")
ACCESS_TYPES = {
    "table": {"read": READ, "write": WRITE, "all": ALL},
    "url": {
        "read": ("read",), "select": ("read",),
        "write": ("read", "write"), "insert": ("read", "write"), "update": ("read", "write"),
        "delete": ("read", "write"), "all": ("read", "write"),
    },
}
CATALOG = "iceberg"
ROWFILTER_ENDING = "__rowfilter"
MATRIX_COLUMNS = ("role", "database", "tables", "columns", "url", "permissions", "groups", "users", "rowfilter",
                  "item_type", "policy_label")
GRANT = ("policy", "role", "item_type")
APPLIED = ("CREATED", "UPDATED")


# ------------------------------------------------------------------ matrix


def fill_down(matrix: DataFrame, sheet: str = "sheet", index: str = "row_index",
              chunk_rows: int = 65_536) -> DataFrame:
    """Matrix with resource cells filled from the rows above, per sheet.

    A row with a database, or with a url, opens a block and ends the one before. Tables and columns
    fill within a block and start at ``*``; labels fill across blocks. Item cells never fill.
    """
    cells = matrix.select(
        sheet, index, *[blank_to_null(c).alias(c) if c != "url" else _url_cell().alias(c) for c in MATRIX_COLUMNS])
    opens = F.col("database").isNotNull() | F.col("url").isNotNull()
    at = F.col(index)

    def when_set(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.struct(at.alias("at"), F.col(name).alias("v")))

    filled = ordered.carry_forward(cells, [sheet], index, {
        "_block": F.when(opens, F.struct(at.alias("at"), F.col("database").alias("db"), F.col("url").alias("url"))),
        "_tables": when_set("tables"),
        "_columns": when_set("columns"),
        "_label": when_set("policy_label"),
    }, chunk_rows)

    def in_block(name: str) -> Column:
        inside = F.col(f"{name}.at") >= F.col("_block.at")
        return F.coalesce(F.when(inside, F.col(f"{name}.v")), F.lit("*"))

    return (
        filled.withColumn("database", F.col("_block.db"))
        .withColumn("url", F.col("_block.url"))
        .withColumn("tables", in_block("_tables"))
        .withColumn("columns", in_block("_columns"))
        .withColumn("policy_label", F.col("_label.v"))
        .drop("_block", "_tables", "_columns", "_label")
    )


def _url_cell() -> Column:
    url = blank_to_null("url")
    return F.when(~url.isin("-", "*"), url)


def unsafe_rowfilter(c) -> Column:
    """True for filter text with a semicolon or a line break."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).rlike(r"[;\n\r]"), F.lit(False))


def parse_matrix(matrix: DataFrame, sheet: str = "sheet", index: str = "row_index",
                 chunk_rows: int = 65_536) -> tuple[DataFrame, DataFrame]:
    """(valid rows with list cells split, rejected rows with a reason).

    A row filter on an item that is not ``allow`` is reported and dropped; the row itself stays valid.
    """
    rows = fill_down(matrix, sheet, index, chunk_rows)
    item = F.lower(F.col("item_type"))
    rows = (
        rows.withColumn("item_type", F.when(item.isin(*ITEM_TYPES), item).otherwise(F.lit("allow")))
        .withColumn("group_list", list_cell("groups"))
        .withColumn("user_list", list_cell("users"))
        .withColumn("permission_list", permission_list("permissions"))
    )
    has_db, has_url = F.col("database").isNotNull(), F.col("url").isNotNull()
    has_filter, has_groups = F.col("rowfilter").isNotNull(), F.size("group_list") > 0
    no_role = F.col("role").isNull()
    problem = (
        F.when(has_db == has_url, F.lit("needs a database or a url, not both"))
        .when(has_url & has_filter, F.lit("row filter on a url"))
        .when(unsafe_rowfilter("rowfilter"), F.lit("unsafe row filter"))
        .when(no_role & has_groups, F.lit("groups without a role"))
        .when(no_role & (F.size("user_list") == 0), F.lit("no role, group or user"))
    )
    judged = rows.withColumn("reason", problem)
    bad_filter = has_filter & (F.col("item_type") != "allow") & F.col("reason").isNull()
    valid = judged.where(F.col("reason").isNull()).withColumn(
        "rowfilter", F.when(F.col("item_type") == "allow", F.col("rowfilter"))).drop("reason")
    brief = [sheet, index, "role", "database", "url"]
    rejected = judged.where(F.col("reason").isNotNull()).select(*brief, "reason").unionByName(
        judged.where(bad_filter).select(*brief, F.lit("row filter ignored: item is not allow").alias("reason")))
    return valid, rejected


def bind_roles(rows: DataFrame) -> DataFrame:
    """One row per role binding: the row's role with all its users, else ``role_<user>`` per user."""
    own = F.array(F.struct(F.col("role").alias("role"), F.col("user_list").alias("users")))
    per_user = F.transform("user_list", lambda u: F.struct(F.concat(F.lit("role_"), u).alias("role"),
                                                           F.array(u).alias("users")))
    bindings = F.when(F.col("role").isNotNull(), own).otherwise(per_user)
    return (
        rows.withColumn("_binding", F.explode(bindings))
        .withColumn("role", F.col("_binding.role"))
        .withColumn("user_list", F.col("_binding.users"))
        .drop("_binding")
    )


def role_principals(bound: DataFrame) -> DataFrame:
    """Distinct (role, type, principal)."""
    def kind(name: str, column: str) -> DataFrame:
        return bound.select("role", F.lit(name).alias("type"), F.explode(column).alias("principal"))

    return kind("group", "group_list").unionByName(kind("user", "user_list")).distinct()


def expand_policies(bound: DataFrame) -> DataFrame:
    """One row per policy of each binding: a url, or every database x table x column of the row's lists."""
    urls = bound.where(F.col("url").isNotNull()).select(
        "*", F.col("url").alias("policy"), F.lit("url").alias("policy_type"),
        *[F.lit(None).cast("string").alias(c) for c in ("schema", "table", "column")])
    tables = bound.where(F.col("url").isNull())
    tables = tables.withColumn("schema", F.explode(list_cell("database")))
    tables = tables.withColumn("table", F.explode(list_cell("tables")))
    tables = tables.withColumn("column", F.explode(list_cell("columns")))
    tables = tables.withColumn("policy", policy_name(F.lit(CATALOG), "schema", "table", "column")).withColumn(
        "policy_type", F.lit("table"))
    return tables.unionByName(urls)


# ------------------------------------------------------------------ grants


def grant_facts(expanded: DataFrame) -> DataFrame:
    """Merged grants in long form: distinct (policy, role, item_type, kind, value)."""
    def kind(name: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("kind"), v.alias("value")))

    has_filter = F.col("rowfilter").isNotNull()
    row_filter = F.when(has_filter, F.array("rowfilter")).otherwise(F.array().cast("array<string>"))
    facts = F.concat(kind("permission", F.col("permission_list")), kind("group", F.col("group_list")),
                     kind("user", F.col("user_list")), kind("rowfilter", row_filter))
    return expanded.select(*GRANT, F.explode(facts).alias("_f")).select(
        *GRANT, "_f.kind", "_f.value").distinct()


def rowfilter_conflicts(facts: DataFrame, by=GRANT) -> DataFrame:
    """Grants (or, by policy, whole policies) that were given two different row filters."""
    filters = facts.where(F.col("kind") == "rowfilter").groupBy(*by).agg(
        F.count_distinct("value").alias("filters"), F.min("value").alias("one"), F.max("value").alias("other"))
    return filters.where(F.col("filters") > 1)


def grant_summary(facts: DataFrame) -> DataFrame:
    """Per grant: how many permissions, groups and users, and its row filter."""
    def count(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    return facts.groupBy(*GRANT).agg(
        count("permission").alias("permissions"), count("group").alias("groups"), count("user").alias("users"),
        F.max(F.when(F.col("kind") == "rowfilter", F.col("value"))).alias("rowfilter"))


def permission_map(spark: SparkSession) -> DataFrame:
    """Fixed lookup (policy_type, permission, access)."""
    rows = [(t, p, a) for t, words in ACCESS_TYPES.items() for p, accesses in words.items() for a in accesses]
    return spark.createDataFrame(rows, "policy_type string, permission string, access string")


def access_types(permissions: DataFrame, policy_type: str = "policy_type", permission: str = "permission") -> DataFrame:
    """Distinct access types behind permission words; an unknown word stands for itself.

    The lookup has a fixed handful of words, so it is an expression and needs no join.
    """
    word = F.lower(F.trim(F.col(permission)))
    types = None
    for kind, words in ACCESS_TYPES.items():
        for name, accesses in words.items():
            test = (F.col(policy_type) == kind) & (word == name)
            value = F.array(*[F.lit(a) for a in accesses])
            types = F.when(test, value) if types is None else types.when(test, value)
    types = types.otherwise(F.array(word))
    keep = [c for c in permissions.columns if c != permission]
    return permissions.select(*keep, F.explode(types).alias("access")).where(F.col("access") != "").distinct()


def supported_access(accesses: DataFrame, supported: list[str] | None, keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(supported accesses, dropped accesses, grants left without any). ``None`` supports everything."""
    ok = F.lit(True) if supported is None else F.col("access").isin(*supported)
    kept, dropped = accesses.where(ok), accesses.where(~ok)
    state = accesses.groupBy(*keys).agg(F.count_if(ok).alias("_kept"))
    return kept, dropped, state.where(F.col("_kept") == 0).drop("_kept")


def policy_items(accesses: DataFrame) -> DataFrame:
    """One item per policy, item type and role with its sorted access types.

    Access types come from the supported list, which bounds the array.
    """
    return accesses.groupBy("policy", "item_type", "role").agg(
        F.array_join(F.sort_array(F.collect_set("access")), ",").alias("accesses"))


def failing_policies(items: DataFrame, policies: DataFrame) -> DataFrame:
    """Policies without a single allow or deny item."""
    effective = items.where(F.col("item_type").isin("allow", "deny")).select("policy")
    return policies.select("policy").distinct().join(effective, "policy", "left_anti")


def rowfilter_items(expanded: DataFrame) -> DataFrame:
    """Row-filter items at table level (the column is dropped), select only."""
    table = F.when(F.coalesce(F.col("table"), F.lit("*")) != "*", F.col("table"))
    schema = F.when(F.col("schema") != "*", F.col("schema"))
    name = F.concat(F.concat_ws(".", F.lit(CATALOG), schema, table), F.lit(ROWFILTER_ENDING))
    return expanded.where(F.col("rowfilter").isNotNull() & (F.col("policy_type") == "table")).select(
        name.alias("policy"), "role", "rowfilter", F.lit("select").alias("accesses")).distinct()


# ------------------------------------------------------------------ merging into what exists


def merge_items(current: DataFrame, desired: DataFrame) -> DataFrame:
    """Union of access facts (policy, item_type, grp, access) with where each comes from."""
    keys = ["policy", "item_type", "grp", "access"]
    had = current.select(*keys).distinct().withColumn("_had", F.lit(True))
    want = desired.select(*keys).distinct().withColumn("_want", F.lit(True))
    origin = (
        F.when(F.col("_had") & F.col("_want"), F.lit("both"))
        .when(F.col("_had"), F.lit("current")).otherwise(F.lit("desired")))
    return had.join(want, keys, "full_outer").select(*keys, origin.alias("origin"))


def merge_labels(current: DataFrame, desired: DataFrame) -> DataFrame:
    return current.select("policy", "label").union(desired.select("policy", "label")).distinct()


def merge_rowfilters(current: DataFrame, desired: DataFrame, updated: DataFrame | None = None) -> DataFrame:
    """Desired row filter replaces the current one of the same policy and group.

    A policy among the ``updated`` ones (policy) that is not given any row filter is a plain access policy from then on:
    its old row filters go.
    """
    keys = ["policy", "grp"]
    if updated is not None:
        plain = updated.select("policy").distinct().join(desired.select("policy"), "policy", "left_anti")
        current = current.join(plain, "policy", "left_anti")
    old = current.select(*keys, F.col("rowfilter").alias("_old"))
    new = desired.select(*keys, F.col("rowfilter").alias("_new"))
    return old.join(new, keys, "full_outer").select(*keys, F.coalesce("_new", "_old").alias("rowfilter"))


def object_actions(desired: DataFrame, current: DataFrame, key: str, found: str = "UPDATED") -> DataFrame:
    """CREATED for desired objects that do not exist yet, else ``found`` (UPDATED or ALREADY_EXISTS)."""
    have = current.select(key).distinct().withColumn("_have", F.lit(True))
    status = F.when(F.col("_have"), F.lit(found)).otherwise(F.lit("CREATED"))
    return desired.select(key).distinct().join(have, key, "left").select(key, status.alias("status"))


# ------------------------------------------------------------------ mapped principals


def keep_mapped(facts: DataFrame, mapped: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts of applied grants, grants with their state, policies that fail).

    A group or user stays only when (role, principal, type) was mapped. A grant none of whose
    principals was mapped is excluded; a policy without an applied grant fails.
    """
    people = facts.where(F.col("kind").isin("group", "user"))
    pairs = mapped.select("role", F.col("type").alias("kind"), F.col("principal").alias("value")).distinct()
    kept_people = people.join(pairs, ["role", "kind", "value"], "left_semi").select(*facts.columns)
    applied = kept_people.select(*GRANT).distinct().withColumn("_ok", F.lit(True))
    grants = facts.select(*GRANT).distinct().join(applied, list(GRANT), "left").select(
        *GRANT, F.when(F.col("_ok"), F.lit("applied")).otherwise(F.lit("excluded")).alias("state"))
    other = facts.where(~F.col("kind").isin("group", "user")).join(
        applied.drop("_ok"), list(GRANT), "left_semi").select(*facts.columns)
    policies = grants.groupBy("policy").agg(F.count_if(F.col("state") == "applied").alias("_n"))
    failed = policies.where(F.col("_n") == 0).select(
        "policy", F.lit("no role principal of the policy was mapped").alias("error_message"))
    return kept_people.unionByName(other), grants, failed


def final_statuses(grants: DataFrame, results: DataFrame, part_size: int = 10_000) -> DataFrame:
    """Final row of each policy: result status, base-name id, applied roles, note on excluded ones.

    ``results`` has policy, policy_id, status and error_message, row-filter companions included;
    the base policy's id counts. Without a result the policy stays RUNNING. Role lists beyond
    ``part_size`` go on in further rows of the policy (``part`` 1, 2, ...).
    """
    base = F.regexp_replace("policy", ROWFILTER_ENDING + "$", "")
    is_base = ~F.col("policy").endswith(ROWFILTER_ENDING)
    by_base = results.withColumn("_base", base).groupBy("_base").agg(
        F.max(F.when(is_base, F.col("policy_id"))).alias("policy_id"),
        F.max_by(F.struct("status", "error_message"), is_base.cast("int")).alias("_r"))
    by_base = by_base.select(F.col("_base").alias("policy"), "policy_id", "_r.status", "_r.error_message")

    def roles(state: str, out: str) -> DataFrame:
        return ordered.text_lists(grants.where(F.col("state") == state).select("policy", "role"),
                                  ["policy"], ["role"], part_size=part_size).select(
            "policy", "part", F.col("role").alias(out))

    lists = roles("applied", "applied_roles").join(roles("excluded", "excluded_roles"), ["policy", "part"],
                                                   "full_outer")
    out = lists.join(by_base, "policy", "left")
    status = F.coalesce("status", F.lit("RUNNING"))
    note = F.when(F.col("excluded_roles").isNotNull() & (status != "FAILED"),
                  F.concat(F.lit("excluded role(s) without a mapped principal: "), F.col("excluded_roles")))
    message = F.concat_ws(" | ", F.when(F.coalesce("error_message", F.lit("")) != "", F.col("error_message")), note)
    return out.select("policy", "part", F.coalesce("policy_id", "policy").alias("policy_id"),
                      status.alias("status"), "applied_roles", message.alias("error_message"))


def final_status_facts(facts: DataFrame, grants: DataFrame, results: DataFrame) -> DataFrame:
    """Final status of each policy in long form: (policy, policy_id, status, error_message, fact, value).

    One row per user, permission, group and row filter of the policy, and per role left out of it (fact ``excluded``). Its
    groups are the applied roles, or all its roles if none was applied. ``results`` as for ``final_statuses``; a policy
    with different row filters fails. No list is put together, so a policy may have any number of entries.
    """
    base = F.regexp_replace("policy", ROWFILTER_ENDING + "$", "")
    is_base = ~F.col("policy").endswith(ROWFILTER_ENDING)
    own = results.groupBy(base.alias("policy")).agg(
        F.max(F.when(is_base, F.col("policy_id"))).alias("policy_id"),
        F.max_by(F.struct("status", "error_message"), is_base.cast("int")).alias("_r"))
    clashes = rowfilter_conflicts(facts, by=("policy",)).select("policy", F.concat(
        F.lit("different row filters: "), "one", F.lit(" and "), "other").alias("_clash"))
    states = grants.groupBy("policy").agg(F.max(F.col("state") == "applied").alias("_applied"))
    roles = grants.join(states, "policy").where((F.col("state") == "applied") | ~F.col("_applied")).select(
        "policy", F.lit("group").alias("fact"), F.col("role").alias("value"))
    left_out = grants.where("state = 'excluded'").select("policy", F.lit("excluded").alias("fact"), F.col("role").alias("value"))
    entries = facts.where(F.col("kind").isin("user", "permission", "rowfilter")).select(
        "policy", F.col("kind").alias("fact"), "value")
    entries = entries.unionByName(roles).unionByName(left_out).distinct()
    status = F.when(F.col("_clash").isNotNull(), F.lit("FAILED")).otherwise(F.coalesce("_r.status", F.lit("RUNNING")))
    message = F.concat_ws(" | ", F.when(F.coalesce("_r.error_message", F.lit("")) != "", F.col("_r.error_message")), F.col("_clash"))
    heads = states.join(own, "policy", "left").join(clashes, "policy", "left").select(
        "policy", F.coalesce("policy_id", "policy").alias("policy_id"), status.alias("status"), message.alias("error_message"))
    return ordered.salted_join(entries, heads, ["policy"]).select("policy", "policy_id", "status", "error_message", "fact", "value")


# ------------------------------------------------------------------ spreading ids


def spread_ids(objects: DataFrame, applied: DataFrame) -> DataFrame:
    """Policies of each object, one row per object and policy (NULL policy where none applies).

    ``objects`` has object_type, object_name, policy_name, policy_id; ``applied`` has policy_name,
    policy_id and principal (one row per group or user). Policies fill by name (companions too),
    groups and mappings by principal, roles from their mappings, role groups from roles, and directory
    groups from group mappings. An object that already has both values keeps them.

    A principal's policies are a list with a name; equal lists share one. The chain hands on names of lists only, and
    the policies behind them are put in at the end, once per object.
    """
    named = applied.where(
        (F.trim(F.coalesce("policy_name", F.lit(""))) != "") & (F.trim(F.coalesce("policy_id", F.lit(""))) != ""))
    policies = named.select("policy_name", "policy_id").distinct()
    by_policy = policies.select(F.col("policy_name").alias("_name"), "policy_name", "policy_id").unionByName(
        policies.select(F.concat("policy_name", F.lit(ROWFILTER_ENDING)).alias("_name"), "policy_name", "policy_id"))
    by_person = named.where(F.trim(F.coalesce("principal", F.lit(""))) != "").select(
        F.col("principal").alias("_name"), "policy_name", "policy_id").distinct()
    lists, members = _interned(by_person)

    def of(*types: str) -> DataFrame:
        return objects.where(F.col("object_type").isin(*types))

    object_name = F.col("object_name")
    policy_rows = _assign(of("policy"), by_policy, object_name)
    mappings = materialize(_give_lists(of("mapping"), lists, mapping_principal("object_name"), one_each=True), "mappings")
    roles = materialize(_give_lists(of("role"), _lists_by(mappings, mapping_role("object_name")), object_name), "roles")
    role_groups = _give_lists(of("ranger_group"), lists, object_name, one_each=True)
    role_groups = _give_lists(role_groups, _lists_by(roles, object_name), object_name)
    directory = _give_lists(of("keycloak_group"), lists, object_name, one_each=True)
    directory = _give_lists(directory, _lists_by(mappings, mapping_principal("object_name", "group")), object_name)
    chained = mappings.unionByName(roles).unionByName(role_groups).unionByName(directory)
    chained = materialize(chained.distinct(), "object-lists")
    rest = objects.where(~F.col("object_type").isin("policy", "mapping", "role", "ranger_group", "keycloak_group"))
    columns = ["object_type", "object_name", "policy_name", "policy_id"]
    known = chained.where("_list is not null").select("object_type", "object_name", "_list")
    listed = ordered.salted_join(known, members, ["_list"]).select(*columns)
    own = chained.where("_list is null").select(*columns, "_own_name", "_own_id")
    own = own.select("object_type", "object_name", F.coalesce("_own_name", "policy_name").alias("policy_name"),
                     F.coalesce("_own_id", "policy_id").alias("policy_id"))
    return rest.select(*columns).unionByName(policy_rows).unionByName(listed.unionByName(own).distinct())


def _interned(by_person: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((_name, _list) of every principal, (_list, policy_name, policy_id)): equal policy lists share one name.

    Lists are compared by their count and two sums of hashes, 128 bits, added up before the shuffle; a list is named
    after its smallest principal, and only that one's policies are kept.
    """
    def total(*columns) -> Column:
        return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))

    marks = by_person.groupBy("_name").agg(
        F.count("*").alias("_n"), total("policy_name", "policy_id").alias("_a"),
        total(F.lit("list"), "policy_id", "policy_name").alias("_b"))
    marks = materialize(marks, "list-marks")
    heads = marks.groupBy("_n", "_a", "_b").agg(F.min("_name").alias("_list"))
    lists = materialize(marks.join(heads, ["_n", "_a", "_b"]).select("_name", "_list"), "list-names")
    first = lists.where("_name = _list")
    members = ordered.salted_join(by_person, first, ["_name"]).select("_list", "policy_name", "policy_id")
    return lists, materialize(members, "list-members")


def _give_lists(objects: DataFrame, names: DataFrame, key: Column, one_each: bool = False) -> DataFrame:
    """Objects with a blank name or id and no list get those under their key.

    ``names`` has _name and _list, or, for what an object had of its own, _own_name and _own_id. Where a name has one
    list (``one_each``), a principal with very many objects is split.
    """
    for c in ("_list", "_own_name", "_own_id"):
        if c not in objects.columns:
            objects = objects.withColumn(c, F.lit(None).cast("string"))
        if c not in names.columns:
            names = names.withColumn(c, F.lit(None).cast("string"))
    blank = (F.coalesce("policy_id", F.lit("")) == "") | (F.coalesce("policy_name", F.lit("")) == "")
    open_row = blank & F.col("_list").isNull() & F.col("_own_name").isNull()
    given = names.select("_name", F.col("_list").alias("_l"), F.col("_own_name").alias("_on"), F.col("_own_id").alias("_oi"))
    asking = objects.withColumn("_name", F.when(open_row, key))
    met = ordered.salted_join(asking, given, ["_name"], "left") if one_each else asking.join(given, "_name", "left")
    return met.select("object_type", "object_name", "policy_name", "policy_id", F.coalesce("_list", "_l").alias("_list"),
                      F.coalesce("_own_name", "_on").alias("_own_name"), F.coalesce("_own_id", "_oi").alias("_own_id"))


def _lists_by(filled: DataFrame, name: Column) -> DataFrame:
    """Lists of filled objects, and the values that objects had themselves, under a name taken from them."""
    had = F.col("_list").isNull()
    rows = filled.select(
        name.alias("_name"), "_list",
        F.when(had, F.coalesce("_own_name", "policy_name")).alias("_own_name"),
        F.when(had, F.coalesce("_own_id", "policy_id")).alias("_own_id"))
    known = F.col("_list").isNotNull() | (F.coalesce("_own_name", F.lit("")) != "")
    return rows.where(known & (F.col("_name") != "")).distinct()


def _assign(objects: DataFrame, names: DataFrame, key: Column) -> DataFrame:
    """Give objects with a blank name or id the policies listed under their key."""
    source = names.select("_name", F.col("policy_name").alias("_n"), F.col("policy_id").alias("_i"))
    blank = (F.coalesce("policy_id", F.lit("")) == "") | (F.coalesce("policy_name", F.lit("")) == "")
    own = F.when(blank, key)  # NULL meets nothing: such an object keeps what it has
    filled = F.col("_n").isNotNull()
    return objects.withColumn("_name", own).join(source, "_name", "left").select(
        "object_type", "object_name",
        F.when(filled, F.col("_n")).otherwise(F.col("policy_name")).alias("policy_name"),
        F.when(filled, F.col("_i")).otherwise(F.col("policy_id")).alias("policy_id"))


def id_texts(assigned: DataFrame, part_size: int = 10_000) -> DataFrame:
    """Assignments as sorted comma-separated text per object, long lists in numbered parts."""
    return ordered.text_lists(assigned, ["object_type", "object_name"], ["policy_name", "policy_id"],
                              part_size=part_size)


# ------------------------------------------------------------------ statuses and metrics


def mapping_statuses(principals: DataFrame, current: DataFrame, directory: DataFrame) -> DataFrame:
    """Object statuses of a role sync: roles and mappings created or existing, groups existing or missing.

    ``current`` has the mapped (role, type, principal); ``directory`` the known group names (grp).
    """
    roles = object_actions(principals.select("role"), current.select("role"), "role", "ALREADY_EXISTS")
    role_rows = _status("role", roles.withColumnRenamed("role", "object_name"))
    groups = principals.where(F.col("type") == "group").select(F.col("principal").alias("grp")).distinct()
    known = directory.select("grp").distinct().withColumn("_known", F.lit(True))
    group_rows = groups.join(known, "grp", "left").select(
        F.col("grp").alias("object_name"),
        F.when(F.col("_known"), F.lit("ALREADY_EXISTS")).otherwise(F.lit("FAILED")).alias("status"))
    keys = ["role", "type", "principal"]
    had = current.select(*keys).distinct().withColumn("_had", F.lit(True))
    missing_group = groups.join(known, "grp", "left_anti").select(
        F.lit("group").alias("type"), F.col("grp").alias("principal"))
    possible = principals.select(*keys).distinct().join(missing_group, ["type", "principal"], "left_anti")
    mappings = possible.join(had, keys, "left").select(
        mapping_name("role", "principal", "type").alias("object_name"),
        F.when(F.col("_had"), F.lit("ALREADY_EXISTS")).otherwise(F.lit("CREATED")).alias("status"))
    return role_rows.unionByName(_status("keycloak_group", group_rows)).unionByName(_status("mapping", mappings))


def outage_statuses(principals: DataFrame, error: str) -> DataFrame:
    """Every role, group and mapping as FAILED when the directory could not be reached."""
    names = (
        principals.select(F.lit("role").alias("object_type"), F.col("role").alias("object_name"))
        .unionByName(principals.where(F.col("type") == "group").select(
            F.lit("keycloak_group").alias("object_type"), F.col("principal").alias("object_name")))
        .unionByName(principals.select(F.lit("mapping").alias("object_type"),
                                       mapping_name("role", "principal", "type").alias("object_name")))
    ).distinct()
    return names.withColumn("status", F.lit("FAILED")).withColumn("error_message", F.lit(error))


def _status(object_type: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(object_type).alias("object_type"), "object_name", "status")


def run_metrics(statuses: DataFrame) -> DataFrame:
    """One row: objects by type and status, totals and the overall status.

    A leftover RUNNING object counts as failed.
    """
    status = F.when(F.col("status") == "RUNNING", F.lit("FAILED")).otherwise(F.col("status"))
    rows = statuses.withColumn("status", status)

    def n(types: tuple[str, ...], wanted: str) -> Column:
        return F.count_if(F.col("object_type").isin(*types) & (F.col("status") == wanted))

    out = rows.agg(
        n(("ranger_group",), "CREATED").alias("groups_created"),
        n(("ranger_group",), "ALREADY_EXISTS").alias("groups_existing"),
        n(("policy",), "CREATED").alias("policies_created"),
        n(("policy",), "UPDATED").alias("policies_updated"),
        n(("policy",), "FAILED").alias("policies_failed"),
        n(("role",), "CREATED").alias("roles_created"),
        n(("role",), "ALREADY_EXISTS").alias("roles_existing"),
        n(("mapping",), "CREATED").alias("mappings_created"),
        n(("mapping",), "ALREADY_EXISTS").alias("mappings_existing"),
        F.count(F.lit(1)).alias("total_objects"),
        F.count_if(F.col("status").isin("CREATED", "UPDATED", "ALREADY_EXISTS")).alias("successful_objects"),
        F.count_if(F.col("status") == "FAILED").alias("failed_objects"),
    )
    overall = F.when(F.col("failed_objects") > 0, F.lit("PARTIAL_FAILURE")).otherwise(F.lit("COMPLETED"))
    return out.withColumn("overall_status", overall)
