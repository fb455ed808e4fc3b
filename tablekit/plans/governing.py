"""Access policies from the sample tables: customer and nation rows stand for matrix rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as words
from ..operators import policy
from ..session import materialize
from .base import read, text

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return add


# ------------------------------------------------------------------ matrix

# One sheet per market segment, rows in customer order; the account balance decides which cells are filled.
MATRIX = """
WITH m AS (SELECT c_mktsegment AS sheet, c_custkey AS row_index, c_acctbal AS b, c_nationkey AS n,
  CASE WHEN c_nationkey >= 10 THEN 'role_'||c_nationkey END AS role,
  CASE WHEN c_acctbal > 7000 AND c_nationkey > 2 THEN 'db'||c_nationkey||CASE WHEN c_acctbal > 9000 THEN ', *' ELSE '' END WHEN c_acctbal > 9800 THEN 'dbx' END AS db,
  CASE WHEN c_acctbal > 7000 AND c_nationkey = 1 THEN 's3a://b/'||c_custkey WHEN c_acctbal > 9800 AND c_nationkey < 3 THEN 's3a://both' END AS url,
  CASE WHEN c_acctbal BETWEEN 3000 AND 9000 AND c_nationkey % 2 = 0 THEN 't'||c_nationkey||', t_all' END AS tbls,
  CASE WHEN c_acctbal BETWEEN 4000 AND 4500 THEN 'col'||c_nationkey END AS cols,
  CASE WHEN c_acctbal > 9500 THEN 'label'||c_nationkey END AS label,
  CASE WHEN c_nationkey < 8 THEN 'all' WHEN c_nationkey < 12 THEN 'read,  Write' WHEN c_nationkey < 15 THEN 'select,custom' END AS perms,
  CASE WHEN c_nationkey IN (9, 11, 13) THEN 'g'||c_nationkey||',g_all' END AS grps,
  CASE WHEN c_nationkey NOT IN (9, 11) AND c_acctbal < 8000 THEN 'u'||c_custkey||', u'||c_nationkey END AS usrs,
  CASE WHEN c_nationkey = 12 THEN 'a=1; drop' WHEN c_nationkey = 14 THEN 'region = ''x''' WHEN c_nationkey = 16 AND c_acctbal > 5000 THEN 'region = ''y''' END AS rf,
  CASE WHEN c_nationkey = 14 AND c_acctbal < 2000 THEN 'deny' WHEN c_nationkey = 17 THEN 'Deny_Exception' WHEN c_nationkey = 18 THEN 'deny' WHEN c_nationkey = 19 THEN 'odd' END AS item FROM customer),
f AS (SELECT *, last_value(CASE WHEN db IS NOT NULL OR url IS NOT NULL THEN row_index END IGNORE NULLS) OVER w AS blk,
  last_value(CASE WHEN tbls IS NOT NULL THEN (row_index, tbls) END IGNORE NULLS) OVER w AS lt, last_value(CASE WHEN cols IS NOT NULL THEN (row_index, cols) END IGNORE NULLS) OVER w AS lc,
  last_value(label IGNORE NULLS) OVER w AS ll FROM m WINDOW w AS (PARTITION BY sheet ORDER BY row_index ROWS UNBOUNDED PRECEDING)),
d AS (SELECT f.sheet, f.row_index, f.role, o.db, o.url, CASE WHEN lt[1] >= blk THEN lt[2] ELSE '*' END AS tbls, CASE WHEN lc[1] >= blk THEN lc[2] ELSE '*' END AS cols, ll AS label,
  f.perms, f.grps, f.usrs, f.rf, f.item FROM f LEFT JOIN m o ON o.sheet = f.sheet AND o.row_index = f.blk),
x AS (SELECT *, CASE WHEN lower(item) IN ('allow', 'allow_exception', 'deny', 'deny_exception') THEN lower(item) ELSE 'allow' END AS it,
  CASE WHEN (db IS NULL) = (url IS NULL) THEN 'needs a database or a url, not both' WHEN url IS NOT NULL AND rf IS NOT NULL THEN 'row filter on a url'
    WHEN contains(rf, ';') THEN 'unsafe row filter' WHEN role IS NULL AND grps IS NOT NULL THEN 'groups without a role'
    WHEN role IS NULL AND usrs IS NULL THEN 'no role, group or user' END AS reason FROM d),
v AS (SELECT sheet, row_index, role, db, url, tbls, cols, label, it, CASE WHEN it = 'allow' THEN rf END AS rf,
  CASE WHEN perms = 'all' THEN ['all'] WHEN perms LIKE 'read%' THEN ['read', 'write'] WHEN perms LIKE 'sel%' THEN ['select', 'custom'] ELSE ['read'] END AS pl,
  CASE WHEN grps IS NULL THEN []::VARCHAR[] ELSE list_transform(string_split(grps, ','), lambda g: trim(g)) END AS gl,
  CASE WHEN usrs IS NULL THEN []::VARCHAR[] ELSE list_transform(string_split(usrs, ','), lambda u: trim(u)) END AS ul FROM x WHERE reason IS NULL),
b AS (SELECT * EXCLUDE (role, ul), role, ul FROM v WHERE role IS NOT NULL UNION ALL SELECT * EXCLUDE (role, ul, u), 'role_'||u, [u] FROM (SELECT *, unnest(ul) AS u FROM v WHERE role IS NULL))"""


def matrix(spark: SparkSession, d: str) -> DataFrame:
    n, b = F.col("c_nationkey"), F.col("c_acctbal")
    ns, key = text("c_nationkey"), text("c_custkey")
    many = F.when(b > 9000, F.lit(", *")).otherwise(F.lit(""))
    return read(spark, d, "customer").select(
        F.col("c_mktsegment").alias("sheet"), F.col("c_custkey").alias("row_index"),
        F.when(n >= 10, F.concat(F.lit("role_"), ns)).otherwise(F.lit("nan")).alias("role"),
        F.when((b > 7000) & (n > 2), F.concat(F.lit(" db"), ns, many)).when(b > 9800, F.lit("dbx")).otherwise(F.lit("")).alias("database"),
        F.when(b.between(3000, 9000) & (n % 2 == 0), F.concat(F.lit("t"), ns, F.lit(", t_all"))).alias("tables"),
        F.when(b.between(4000, 4500), F.concat(F.lit("col"), ns)).otherwise(F.lit("None")).alias("columns"),
        F.when((b > 7000) & (n == 1), F.concat(F.lit("s3a://b/"), key)).when((b > 9800) & (n < 3), F.lit("s3a://both"))
        .otherwise(F.lit("-")).alias("url"),
        F.when(n < 8, "all").when(n < 12, "read,  Write").when(n < 15, "select,custom").alias("permissions"),
        F.when(n.isin(9, 11, 13), F.concat(F.lit("g"), ns, F.lit(",g_all"))).alias("groups"),
        F.when(~n.isin(9, 11) & (b < 8000), F.concat(F.lit("u"), key, F.lit(", u"), ns)).alias("users"),
        F.when(n == 12, "a=1; drop").when(n == 14, "region = 'x'").when((n == 16) & (b > 5000), "region = 'y'").alias("rowfilter"),
        F.when((n == 14) & (b < 2000), "deny").when(n == 17, "Deny_Exception").when(n == 18, "deny").when(n == 19, "odd").alias("item_type"),
        F.when(b > 9500, F.concat(F.lit("label"), ns)).alias("policy_label"))


def bound_rows(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = policy.parse_matrix(matrix(spark, d), chunk_rows=1000)
    return policy.bind_roles(valid)


@query(f"""{MATRIX} SELECT sheet, row_index, role, db AS database, url, tbls AS "tables", cols AS "columns", label AS policy_label FROM d""")
def matrix_fill_down(spark, d):
    return policy.fill_down(matrix(spark, d), chunk_rows=1000).select(
        "sheet", "row_index", "role", "database", "url", "tables", "columns", "policy_label")


@query(f"""{MATRIX}
SELECT sheet, row_index, role, db AS database, url, reason FROM x WHERE reason IS NOT NULL
UNION ALL SELECT sheet, row_index, role, db, url, 'row filter ignored: item is not allow' FROM x WHERE reason IS NULL AND rf IS NOT NULL AND it <> 'allow'""")
def matrix_rejects(spark, d):
    return policy.parse_matrix(matrix(spark, d), chunk_rows=1000)[1]


@query(f"""{MATRIX} SELECT sheet, row_index, role, it AS item_type, list_aggregate(ul, 'string_agg', ',') AS users, list_aggregate(gl, 'string_agg', ',') AS groups, list_aggregate(pl, 'string_agg', ',') AS permissions FROM b""")
def bind_roles(spark, d):
    def joined(c: str):
        return F.when(F.size(c) > 0, F.array_join(c, ","))

    return bound_rows(spark, d).select(
        "sheet", "row_index", "role", "item_type", joined("user_list").alias("users"), joined("group_list").alias("groups"),
        joined("permission_list").alias("permissions"))


@query(f"""{MATRIX} SELECT DISTINCT role, 'group' AS type, unnest(gl) AS principal FROM b UNION SELECT DISTINCT role, 'user', unnest(ul) FROM b""")
def role_principals(spark, d):
    return policy.role_principals(bound_rows(spark, d))


EXPANDED = f"""{MATRIX},
e0 AS (SELECT * EXCLUDE (db, tbls, cols), unnest(list_transform(string_split(db, ','), lambda z: trim(z))) AS s, tbls, cols FROM b WHERE url IS NULL),
e1 AS (SELECT * EXCLUDE (tbls), unnest(list_transform(string_split(tbls, ','), lambda z: trim(z))) AS t FROM e0),
e2 AS (SELECT * EXCLUDE (cols), unnest(list_transform(string_split(cols, ','), lambda z: trim(z))) AS c FROM e1),
ex AS (SELECT sheet, row_index, role, it, rf, pl, gl, ul, 'table' AS pt, s, t, c, CASE WHEN s = '*' THEN 'iceberg' ELSE 'iceberg.'||s||
    CASE WHEN t <> '*' THEN '.'||t||CASE WHEN c <> '*' THEN '.'||c ELSE '' END WHEN c <> '*' THEN '.*.'||c ELSE '' END END AS policy FROM e2
  UNION ALL SELECT sheet, row_index, role, it, rf, pl, gl, ul, 'url', NULL, NULL, NULL, url FROM b WHERE url IS NOT NULL)"""


def expanded(spark: SparkSession, d: str) -> DataFrame:
    return policy.expand_policies(bound_rows(spark, d))


@query(f"""{EXPANDED} SELECT sheet, row_index, role, it AS item_type, pt AS policy_type, policy, s AS "schema", t AS "table", c AS "column" FROM ex""")
def expand_policies(spark, d):
    return expanded(spark, d).select("sheet", "row_index", "role", "item_type", "policy_type", "policy", "schema", "table", "column")


FACTS = f"""{EXPANDED},
facts AS (SELECT DISTINCT policy, role, it AS item_type, 'permission' AS kind, unnest(pl) AS value FROM ex UNION SELECT policy, role, it, 'group', unnest(gl) FROM ex
  UNION SELECT policy, role, it, 'user', unnest(ul) FROM ex UNION SELECT policy, role, it, 'rowfilter', rf FROM ex WHERE rf IS NOT NULL)"""


def facts(spark: SparkSession, d: str) -> DataFrame:
    return policy.grant_facts(expanded(spark, d))


def stored_facts(spark: SparkSession, d: str) -> DataFrame:
    """Facts written once for jobs that read them several times."""
    return materialize(facts(spark, d), "facts")


@query(f"""{FACTS}
SELECT policy, role, item_type, count(*) FILTER (kind = 'permission')::BIGINT AS permissions, count(*) FILTER (kind = 'group')::BIGINT AS groups, count(*) FILTER (kind = 'user')::BIGINT AS users,
  max(value) FILTER (kind = 'rowfilter') AS rowfilter FROM facts GROUP BY 1, 2, 3""")
def merge_grants(spark, d):
    return policy.grant_summary(facts(spark, d))


@query(f"""{FACTS} SELECT policy, count(DISTINCT value)::BIGINT AS filters, min(value) AS one, max(value) AS other FROM facts WHERE kind = 'rowfilter' GROUP BY 1 HAVING count(DISTINCT value) > 1""")
def rowfilter_conflicts(spark, d):
    return policy.rowfilter_conflicts(facts(spark, d), by=("policy",))


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


ACCESS_SQL = "CASE " + " ".join(
    f"WHEN pt = '{kind}' AND value = '{word}' THEN {_list(accesses)}"
    for kind, names in policy.ACCESS_TYPES.items() for word, accesses in names.items()) + " ELSE [value] END"
SUPPORTED = ("select", "insert", "update", "delete", "use", "show", "read", "write", "grant")
ACCESS = f"""{FACTS},
acc AS (SELECT DISTINCT policy, role, item_type, pt, unnest({ACCESS_SQL}) AS access FROM (SELECT f.*, CASE WHEN starts_with(policy, 's3a:') THEN 'url' ELSE 'table' END AS pt FROM facts f WHERE kind = 'permission')),
k AS (SELECT * FROM acc WHERE access IN ({', '.join(repr(s) for s in SUPPORTED)}))"""


def accesses(spark: SparkSession, d: str) -> DataFrame:
    permissions = facts(spark, d).where(F.col("kind") == "permission").select(
        *policy.GRANT, F.when(F.col("policy").startswith("s3a:"), "url").otherwise("table").alias("policy_type"),
        F.col("value").alias("permission"))
    return policy.access_types(permissions)


@query(f"""{ACCESS}
SELECT policy, role, item_type, count(*)::BIGINT AS accesses, count(*) FILTER (access IN ({', '.join(repr(s) for s in SUPPORTED)}))::BIGINT AS kept,
  nullif(string_agg(access, ',' ORDER BY access) FILTER (access NOT IN ({', '.join(repr(s) for s in SUPPORTED)})), '') AS dropped FROM acc GROUP BY 1, 2, 3""")
def access_types(spark, d):
    found = accesses(spark, d)
    ok = F.col("access").isin(*SUPPORTED)
    names = F.array_join(F.sort_array(F.collect_set(F.when(~ok, F.col("access")))), ",")
    return found.groupBy(*policy.GRANT).agg(
        F.count(F.lit(1)).alias("accesses"), F.count_if(ok).alias("kept"), F.nullif(names, F.lit("")).alias("dropped"))


@query(f"""{ACCESS} SELECT policy, item_type, role, string_agg(access, ',' ORDER BY access) AS accesses FROM k GROUP BY 1, 2, 3""")
def policy_items(spark, d):
    kept, _, _ = policy.supported_access(accesses(spark, d), list(SUPPORTED), list(policy.GRANT))
    return policy.policy_items(kept)


@query(f"""{ACCESS}
SELECT 'policy' AS what, policy AS name FROM (SELECT DISTINCT policy FROM acc) WHERE policy NOT IN (SELECT policy FROM k WHERE item_type IN ('allow', 'deny'))
UNION ALL SELECT 'grant', policy||'/'||role||'/'||item_type FROM acc GROUP BY policy, role, item_type HAVING count(*) FILTER (access IN ({', '.join(repr(s) for s in SUPPORTED)})) = 0""")
def unsupported_grants(spark, d):
    found = materialize(accesses(spark, d), "access")
    kept, _, empty = policy.supported_access(found, list(SUPPORTED), list(policy.GRANT))
    failing = policy.failing_policies(policy.policy_items(kept), found)
    return failing.select(F.lit("policy").alias("what"), F.col("policy").alias("name")).unionByName(
        empty.select(F.lit("grant").alias("what"), F.concat_ws("/", *policy.GRANT).alias("name")))


@query(f"""{EXPANDED} SELECT DISTINCT 'iceberg'||CASE WHEN s <> '*' THEN '.'||s ELSE '' END||CASE WHEN t <> '*' THEN '.'||t ELSE '' END||'__rowfilter' AS policy, role, rf AS rowfilter, 'select' AS accesses
FROM ex WHERE rf IS NOT NULL AND pt = 'table'""")
def rowfilter_policies(spark, d):
    return policy.rowfilter_items(expanded(spark, d))


# ------------------------------------------------------------------ merging and statuses

CURRENT = f"""{ACCESS},
cur AS (SELECT policy, item_type, role AS grp, access FROM k WHERE access <> 'select' AND item_type <> 'deny_exception' UNION SELECT policy, 'allow', 'old_group', 'show' FROM k),
des AS (SELECT policy, item_type, role AS grp, access FROM k WHERE role <> 'role_15')"""


def snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    kept, _, _ = policy.supported_access(materialize(accesses(spark, d), "access"), list(SUPPORTED), list(policy.GRANT))
    items = kept.select("policy", "item_type", F.col("role").alias("grp"), "access")
    old = items.select("policy", F.lit("allow").alias("item_type"), F.lit("old_group").alias("grp"), F.lit("show").alias("access"))
    current = items.where((F.col("access") != "select") & (F.col("item_type") != "deny_exception")).unionByName(old)
    return current, items.where(F.col("grp") != "role_15")


@query(f"""{CURRENT}
SELECT policy, item_type, grp, access, CASE WHEN c.access IS NOT NULL AND e.access IS NOT NULL THEN 'both' WHEN c.access IS NOT NULL THEN 'current' ELSE 'desired' END AS origin
FROM cur c FULL JOIN des e USING (policy, item_type, grp, access)""")
def merge_policies(spark, d):
    return policy.merge_items(*snapshots(spark, d))


@query(f"""{FACTS},
cur AS (SELECT DISTINCT policy FROM facts WHERE kind = 'user'), des AS (SELECT DISTINCT policy FROM facts WHERE item_type = 'allow')
SELECT policy, CASE WHEN policy IN (SELECT policy FROM cur) THEN 'UPDATED' ELSE 'CREATED' END AS status FROM des""")
def object_actions(spark, d):
    found = stored_facts(spark, d)
    return policy.object_actions(found.where(F.col("item_type") == "allow"), found.where(F.col("kind") == "user"), "policy")


MAPPED = f"""{FACTS},
mp AS (SELECT DISTINCT role, kind AS type, value AS principal FROM facts WHERE kind IN ('group', 'user') AND value NOT LIKE '%7' AND role NOT LIKE '%20'),
ap AS (SELECT DISTINCT f.policy, f.role, f.item_type FROM facts f JOIN mp ON mp.role = f.role AND mp.type = f.kind AND mp.principal = f.value),
gr AS (SELECT DISTINCT f.policy, f.role, f.item_type, CASE WHEN ap.policy IS NULL THEN 'excluded' ELSE 'applied' END AS state FROM facts f LEFT JOIN ap USING (policy, role, item_type))"""


def mapped_pairs(found: DataFrame) -> DataFrame:
    people = found.where(F.col("kind").isin("group", "user") & ~F.col("value").endswith("7") & ~F.col("role").endswith("20"))
    return people.select("role", F.col("kind").alias("type"), F.col("value").alias("principal")).distinct()


@query(f"""{MAPPED} SELECT f.policy, f.role, f.item_type, kind, value FROM facts f JOIN ap USING (policy, role, item_type)
WHERE kind NOT IN ('group', 'user') OR (f.role, f.kind, f.value) IN (SELECT (role, type, principal) FROM mp)""")
def mapped_principals(spark, d):
    found = stored_facts(spark, d)
    return policy.keep_mapped(found, mapped_pairs(found))[0].select(*policy.GRANT, "kind", "value")


@query(f"""{MAPPED},
rs AS (SELECT DISTINCT policy, CASE WHEN policy LIKE '%t1%' THEN 'FAILED' ELSE 'CREATED' END AS status, CASE WHEN policy LIKE '%t1%' THEN 'refused' ELSE '' END AS err FROM gr WHERE policy NOT LIKE '%db1%'),
ls AS (SELECT policy, string_agg(DISTINCT role, ', ' ORDER BY role) FILTER (state = 'applied') AS ar, string_agg(DISTINCT role, ', ' ORDER BY role) FILTER (state = 'excluded') AS er FROM gr GROUP BY 1)
SELECT ls.policy, 0::BIGINT AS part, CASE WHEN rs.policy IS NULL THEN ls.policy ELSE 'id_'||length(ls.policy) END AS policy_id, coalesce(rs.status, 'RUNNING') AS status, ar AS applied_roles,
  concat_ws(' | ', nullif(rs.err, ''), CASE WHEN er IS NOT NULL AND coalesce(rs.status, 'RUNNING') <> 'FAILED' THEN 'excluded role(s) without a mapped principal: '||er END) AS error_message
FROM ls LEFT JOIN rs USING (policy)""")
def final_statuses(spark, d):
    found = stored_facts(spark, d)
    _, grants, _ = policy.keep_mapped(found, mapped_pairs(found))
    bad = F.col("policy").contains("t1")
    base = grants.where(~F.col("policy").contains("db1")).select("policy").distinct().select(
        "policy", F.concat(F.lit("id_"), text(F.length("policy"))).alias("policy_id"),
        F.when(bad, "FAILED").otherwise("CREATED").alias("status"), F.when(bad, "refused").otherwise("").alias("error_message"))
    companions = base.select(F.concat("policy", F.lit("__rowfilter")).alias("policy"), F.lit("id_x").alias("policy_id"),
                             F.lit("UPDATED").alias("status"), F.lit("").alias("error_message"))
    return policy.final_statuses(grants, base.unionByName(companions))


SPREAD = f"""{MAPPED},
st AS (SELECT DISTINCT policy AS policy_name, 'id_'||length(policy) AS policy_id, value AS principal FROM facts WHERE kind IN ('user', 'group') AND policy NOT LIKE '%t2%'
  UNION SELECT DISTINCT policy, 'id_'||length(policy), role FROM facts WHERE policy NOT LIKE '%t2%'),
pairs AS (SELECT DISTINCT role, kind, value FROM facts WHERE kind IN ('group', 'user')),
pol AS (SELECT DISTINCT policy_name, policy_id FROM st),
o_pol AS (SELECT DISTINCT policy AS name FROM facts UNION SELECT DISTINCT policy||'__rowfilter' FROM facts WHERE kind = 'rowfilter'),
r_pol AS (SELECT 'policy' AS t, name, p.policy_name AS pn, p.policy_id AS pi FROM o_pol LEFT JOIN pol p ON name IN (p.policy_name, p.policy_name||'__rowfilter')),
r_map AS (SELECT 'mapping' AS t, role||'->'||value||' ('||kind||')' AS name, role, kind, value, s.policy_name AS pn, s.policy_id AS pi FROM pairs LEFT JOIN st s ON s.principal = value),
r_role AS (SELECT DISTINCT 'role' AS t, p.role AS name, m.pn, m.pi FROM (SELECT DISTINCT role FROM facts) p LEFT JOIN (SELECT DISTINCT role, pn, pi FROM r_map WHERE pn IS NOT NULL) m ON m.role = p.role),
g1 AS (SELECT 'ranger_group' AS t, p.role AS name, s.policy_name AS pn, s.policy_id AS pi FROM (SELECT DISTINCT role FROM facts) p LEFT JOIN st s ON s.principal = p.role),
r_rg AS (SELECT g1.t, g1.name, coalesce(g1.pn, r.pn) AS pn, coalesce(g1.pi, r.pi) AS pi FROM g1 LEFT JOIN r_role r ON g1.pn IS NULL AND r.name = g1.name AND r.pn IS NOT NULL),
r_kg AS (SELECT 'keycloak_group' AS t, p.value AS name, s.policy_name AS pn, s.policy_id AS pi FROM (SELECT DISTINCT value FROM pairs WHERE kind = 'group') p LEFT JOIN st s ON s.principal = p.value),
allr AS (SELECT t, name, pn, pi FROM r_pol UNION SELECT t, name, pn, pi FROM r_map UNION SELECT t, name, pn, pi FROM r_role UNION SELECT t, name, pn, pi FROM r_rg UNION SELECT t, name, pn, pi FROM r_kg)"""


@query(f"""{SPREAD}
SELECT t AS object_type, name AS object_name, coalesce(string_agg(DISTINCT pn, ', ' ORDER BY pn), '') AS policy_name, coalesce(string_agg(DISTINCT pi, ', ' ORDER BY pi), '') AS policy_id, 0::BIGINT AS part, 1::BIGINT AS parts
FROM allr GROUP BY 1, 2""")
def spread_ids(spark, d):
    found = stored_facts(spark, d)
    with_id = F.concat(F.lit("id_"), text(F.length("policy")))
    used = found.where(~F.col("policy").contains("t2"))
    people = used.where(F.col("kind").isin("group", "user"))
    applied = people.select(F.col("policy").alias("policy_name"), with_id.alias("policy_id"), F.col("value").alias("principal")).unionByName(
        used.select(F.col("policy").alias("policy_name"), with_id.alias("policy_id"), F.col("role").alias("principal"))).distinct()
    pairs = found.where(F.col("kind").isin("group", "user")).select("role", "kind", "value").distinct()

    def objects(kind: str, names: DataFrame) -> DataFrame:
        return names.select(F.lit(kind).alias("object_type"), names[names.columns[0]].alias("object_name"),
                            F.lit(None).cast("string").alias("policy_name"), F.lit("").alias("policy_id"))

    companion = found.where(F.col("kind") == "rowfilter").select(F.concat("policy", F.lit("__rowfilter")).alias("name")).distinct()
    roles = found.select("role").distinct()
    every = (
        objects("policy", found.select("policy").distinct()).unionByName(objects("policy", companion))
        .unionByName(objects("mapping", pairs.select(words.mapping_name("role", "value", "kind").alias("name"))))
        .unionByName(objects("role", roles)).unionByName(objects("ranger_group", roles))
        .unionByName(objects("keycloak_group", pairs.where(F.col("kind") == "group").select("value").distinct())))
    return policy.id_texts(policy.spread_ids(every, applied))


STATUSES = f"""{MAPPED},
pr AS (SELECT DISTINCT role, kind AS type, value AS principal FROM facts WHERE kind IN ('group', 'user')),
cu AS (SELECT * FROM mp WHERE role NOT LIKE '%13'), di AS (SELECT DISTINCT principal AS grp FROM pr WHERE type = 'group' AND principal <> 'g13'),
ss AS (SELECT DISTINCT 'role' AS object_type, role AS object_name, CASE WHEN role IN (SELECT role FROM cu) THEN 'ALREADY_EXISTS' ELSE 'CREATED' END AS status FROM pr
  UNION ALL SELECT DISTINCT 'keycloak_group', principal, CASE WHEN principal IN (SELECT grp FROM di) THEN 'ALREADY_EXISTS' ELSE 'FAILED' END FROM pr WHERE type = 'group'
  UNION ALL SELECT 'mapping', role||'->'||principal||' ('||type||')', CASE WHEN (role, type, principal) IN (SELECT (role, type, principal) FROM cu) THEN 'ALREADY_EXISTS' ELSE 'CREATED' END
    FROM pr WHERE type = 'user' OR principal IN (SELECT grp FROM di))"""


def sync_statuses(spark: SparkSession, d: str) -> DataFrame:
    found = stored_facts(spark, d)
    people = found.where(F.col("kind").isin("group", "user")).select(
        "role", F.col("kind").alias("type"), F.col("value").alias("principal")).distinct()
    current = mapped_pairs(found).where(~F.col("role").endswith("13"))
    directory = people.where((F.col("type") == "group") & (F.col("principal") != "g13")).select(F.col("principal").alias("grp"))
    return policy.mapping_statuses(people, current, directory)


@query(f"{STATUSES} SELECT object_type, object_name, status FROM ss")
def object_statuses(spark, d):
    return sync_statuses(spark, d)


@query(f"""{STATUSES}
SELECT 0::BIGINT AS groups_created, 0::BIGINT AS groups_existing, 0::BIGINT AS policies_created, 0::BIGINT AS policies_updated, 0::BIGINT AS policies_failed,
  count(*) FILTER (object_type = 'role' AND status = 'CREATED')::BIGINT AS roles_created, count(*) FILTER (object_type = 'role' AND status = 'ALREADY_EXISTS')::BIGINT AS roles_existing,
  count(*) FILTER (object_type = 'mapping' AND status = 'CREATED')::BIGINT AS mappings_created, count(*) FILTER (object_type = 'mapping' AND status = 'ALREADY_EXISTS')::BIGINT AS mappings_existing,
  count(*)::BIGINT AS total_objects, count(*) FILTER (status <> 'FAILED')::BIGINT AS successful_objects, count(*) FILTER (status = 'FAILED')::BIGINT AS failed_objects,
  CASE WHEN count(*) FILTER (status = 'FAILED') > 0 THEN 'PARTIAL_FAILURE' ELSE 'COMPLETED' END AS overall_status FROM ss""")
def policy_metrics(spark, d):
    return policy.run_metrics(sync_statuses(spark, d))


@query(f"""{STATUSES},
al AS (SELECT DISTINCT 'role' AS t, role AS n FROM pr UNION SELECT 'keycloak_group', principal FROM pr WHERE type = 'group' UNION SELECT 'mapping', role||'->'||principal||' ('||type||')' FROM pr)
SELECT t AS object_type, count(*)::BIGINT AS failed FROM al GROUP BY 1""")
def outage(spark, d):
    people = stored_facts(spark, d).where(F.col("kind").isin("group", "user")).select(
        "role", F.col("kind").alias("type"), F.col("value").alias("principal"))
    return policy.outage_statuses(people, "directory unreachable").groupBy("object_type").agg(
        F.count_if(F.col("status") == "FAILED").alias("failed"))
