"""The views of `views.py` as SQL, to be put in front of a query."""

from __future__ import annotations

from gleanery import schemas as S
from gleanery.catalogue.views import has_gap, kind_of, type_index


def uuid_sql(text: str) -> str:
    groups = "(.{8})(.{4})(.{4})(.{4})(.{12})"
    return f"regexp_replace(md5({text}), '{groups}', '\\1-\\2-\\3-\\4-\\5')"


def stamp_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def _code_id(code: S.Code) -> str:
    index = type_index(code.list_type)
    order = "ascii(o_orderstatus)" if kind_of(code.list_type) == "S" else "CAST(substr(o_orderpriority, 1, 1) AS INT)"
    return f"CASE WHEN o_orderkey % {index + 7} <> 0 THEN CAST({index * 100} + {order} AS BIGINT) END AS {code.column}"


def _types() -> str:
    rows = ", ".join(
        f"('{kind_of(t)}', {type_index(t)}, '{t}', {str(has_gap(t)).lower()})" for t in S.ALL_CODE_TYPES
    )
    return f"(VALUES {rows}) AS t(kind, id_type, mnemonique, gap)"


def _dataset_code(d: S.Code) -> str:
    index, kind = type_index(d.list_type), kind_of(d.list_type)
    value = f"{index * 100 + 70}" if kind == "S" else f"{index * 100 + 1} + c_custkey % 5"
    return f"CASE WHEN c_custkey % {index + 3} <> 0 THEN CAST({value} AS BIGINT) END AS {d.column}"


_T, _O, _TH, _R = (
    type_index(t) * 100 for t in (S.TERRITORY_TYPE, S.OBJECTIVE_TYPE, S.THEME_TYPE, S.ACTOR_ROLE_TYPE)
)

VIEWS: dict[str, str] = {
    "codes": f"""
        SELECT CAST(t.id_type * 100 + f.ord AS BIGINT) AS id_nomenclature, t.id_type, t.mnemonique,
               f.cd AS cd_nomenclature, lower(f.label) AS label_default,
               f.ord = CASE f.kind WHEN 'S' THEN 70 WHEN 'M' THEN 65 ELSE 1 END AS is_default
        FROM (SELECT DISTINCT 'S' AS kind, o_orderstatus AS cd, ascii(o_orderstatus) AS ord, o_orderstatus AS label FROM orders
              UNION ALL
              SELECT DISTINCT 'P', substr(o_orderpriority, 1, 1), CAST(substr(o_orderpriority, 1, 1) AS INT), o_orderpriority FROM orders
              UNION ALL
              SELECT DISTINCT 'M', c_mktsegment, ascii(c_mktsegment), c_mktsegment FROM customer
              UNION ALL
              SELECT DISTINCT 'B', p_brand, CAST(substr(p_brand, 7) AS INT), p_brand FROM part) f
        JOIN {_types()} ON t.kind = f.kind
        WHERE NOT (t.gap AND f.cd IN ('P', '5'))""",
    "areas": """
        SELECT CAST(n_nationkey AS BIGINT) AS id_area, r_name AS type_code, n_name AS area_code
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "facts": f"""
        SELECT o_orderkey AS id_synthese, CAST(o_orderkey AS VARCHAR) AS entity_source_pk_value,
               {uuid_sql("'o' || o_orderkey")} AS unique_id_sinp,
               CASE WHEN o_orderkey % 3 = 0 THEN {uuid_sql("'g' || o_custkey")} END AS unique_id_sinp_grp,
               o_orderkey % 2 + 1 AS id_source, o_custkey AS id_dataset,
               o_orderdate AS date_min, o_orderdate + INTERVAL 1 DAY AS date_max,
               CAST(o_custkey AS INT) AS cd_nom, 'v16' AS meta_v_taxref, o_orderpriority AS nom_cite,
               CAST(1 AS INT) AS count_min, CAST(floor(o_totalprice / 1000) AS INT) AS count_max,
               CAST(o_orderkey % 1000 AS INT) AS altitude_min, CAST(o_orderkey % 1000 + 100 AS INT) AS altitude_max,
               CAST(NULL AS INT) AS depth_min, CAST(NULL AS INT) AS depth_max,
               'observer ' || o_custkey AS observers,
               CASE WHEN o_orderkey % 5 = 0 THEN 'expert ' || (o_orderkey % 11) END AS determiner,
               CAST(NULL AS VARCHAR) AS validator, CAST(NULL AS VARCHAR) AS sample_number_proof,
               CAST(NULL AS VARCHAR) AS digital_proof, CAST(NULL AS VARCHAR) AS non_digital_proof,
               o_orderstatus AS comment_context, CAST(NULL AS VARCHAR) AS comment_description,
               CAST(NULL AS VARCHAR) AS reference_biblio, 'place ' || (o_orderkey % 97) AS place_name,
               CAST(o_orderkey % 500 AS INT) AS precision, CAST(NULL AS VARCHAR) AS grp_method,
               CAST(substr(o_orderpriority, 1, 1) AS INT) AS cd_hab,
               '{{"price":' || CAST(floor(o_totalprice) AS BIGINT) || '}}' AS additional_data,
               'POINT(' || (o_custkey % 360 - 180) || ' ' || (o_custkey % 180 - 90) || ')' AS the_geom_4326,
               o_custkey % 30 AS id_area_attachment, o_orderdate AS meta_create_date,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate + INTERVAL 30 DAY END AS meta_update_date,
               {", ".join(_code_id(c) for c in S.CODES)}
        FROM orders""",
    "habitats": """
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS cd_hab, lower(o_orderpriority) AS lb_hab_fr
        FROM orders""",
    "datasets": f"""
        SELECT c_custkey AS id_dataset, {uuid_sql("'d' || c_custkey")} AS unique_dataset_id,
               CAST(c_nationkey AS BIGINT) AS id_acquisition_framework, c_name AS dataset_name,
               left(c_name, 12) AS dataset_shortname,
               CASE WHEN c_custkey % 7 <> 0 THEN 'about ' || c_mktsegment END AS dataset_desc,
               c_acctbal < 0 AS marine_domain, c_acctbal >= 0 AS terrestrial_domain, lower(c_mktsegment) AS keywords,
               {", ".join(_dataset_code(d) for d in S.DATASET_CODES)}
        FROM customer""",
    "frameworks": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS id_acquisition_framework,
               {uuid_sql("'a' || n_nationkey")} AS unique_acquisition_framework_id,
               n_name AS acquisition_framework_name, 'framework of ' || n_name AS acquisition_framework_desc,
               DATE '2000-01-01' + n_nationkey AS acquisition_framework_start_date,
               CAST(NULL AS VARCHAR) AS acquisition_framework_end_date, CAST(NULL AS VARCHAR) AS initial_closing_date,
               CAST(NULL AS VARCHAR) AS territory_desc, lower(n_name) AS target_description,
               CAST(NULL AS VARCHAR) AS ecologic_or_geologic_target, n_nationkey < 5 AS is_parent,
               CASE WHEN n_nationkey >= 5 THEN CAST(n_regionkey AS BIGINT) END AS acquisition_framework_parent_id,
               {", ".join(f"CAST({type_index(c.list_type) * 100 + 1} + n_nationkey % 6 AS BIGINT) AS {c.column}" for c in S.FRAMEWORK_CODES)}
        FROM nation""",
    "organisms": f"""
        SELECT s_suppkey AS id_organisme, {uuid_sql("'s' || s_suppkey")} AS uuid_organisme, s_name AS nom_organisme,
               CASE WHEN s_nationkey <> 0 THEN s_name || '@example.org' END AS email_organisme
        FROM supplier""",
    "roles": f"""
        SELECT s_suppkey AS id_role, {uuid_sql("'r' || s_suppkey")} AS uuid_role, 'Name ' || s_suppkey AS nom_role,
               'First ' || s_nationkey AS prenom_role,
               CASE WHEN s_suppkey % 2 = 0 THEN 'p' || s_suppkey || '@example.org' END AS email
        FROM supplier""",
    "dataset_actors": f"""
        SELECT DISTINCT o_custkey AS id_dataset,
               CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 100 END AS id_organism,
               CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 100 END AS id_role,
               CAST({_R} + ascii(o_orderstatus) AS BIGINT) AS id_nomenclature_actor_role
        FROM orders""",
    "framework_actors": f"""
        SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS id_acquisition_framework,
               CAST(ascii(c_mktsegment) AS BIGINT) AS id_organism, CAST(NULL AS BIGINT) AS id_role,
               CAST({_R + 70} AS BIGINT) AS id_nomenclature_actor_role
        FROM customer""",
    "dataset_territories": f"""
        SELECT DISTINCT o_custkey AS id_dataset,
               CAST({_T} + CAST(substr(p_brand, 7) AS INT) AS BIGINT) AS id_nomenclature_territory
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""",
    "protocols": f"""
        SELECT DISTINCT CAST(ascii(c_mktsegment) AS BIGINT) AS id_protocol,
               {uuid_sql("'p' || c_mktsegment")} AS unique_protocol_id, c_mktsegment AS protocol_name,
               CAST(NULL AS VARCHAR) AS protocol_desc, 'http://example.org/' || lower(c_mktsegment) AS protocol_url,
               CAST({type_index("DATA_TYP") * 100 + 1} + ascii(c_mktsegment) % 5 AS BIGINT) AS id_nomenclature_protocol_type
        FROM customer""",
    "dataset_protocols": """
        SELECT c_custkey AS id_dataset, CAST(ascii(c_mktsegment) AS BIGINT) AS id_protocol FROM customer WHERE c_acctbal >= 0
        UNION ALL
        SELECT c_custkey, CASE WHEN ascii(c_mktsegment) = 65 THEN 66 ELSE 65 END FROM customer WHERE c_acctbal > 5000""",
    "framework_territories": f"""
        SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS id_acquisition_framework,
               CAST({_T + 1} + c_custkey % 27 AS BIGINT) AS id_nomenclature_territory FROM customer""",
    "framework_objectives": f"""
        SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS id_acquisition_framework,
               CAST({_O} + ascii(c_mktsegment) AS BIGINT) AS id_nomenclature_objectif FROM customer""",
    "framework_themes": f"""
        SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS id_acquisition_framework,
               CAST({_TH + 1} + s_suppkey % 5 AS BIGINT) AS id_nomenclature_voletsinp FROM supplier""",
    "framework_publications": """
        SELECT CAST(n_nationkey AS BIGINT) AS id_acquisition_framework, CAST(n_regionkey AS BIGINT) AS id_publication FROM nation
        UNION ALL SELECT n_nationkey, 0 FROM nation""",
    "publications": f"""
        SELECT CAST(r_regionkey AS BIGINT) AS id_publication, {uuid_sql("'b' || r_regionkey")} AS unique_publication_id,
               r_name AS publication_reference, CAST(NULL AS VARCHAR) AS publication_url FROM region""",
    "change_log": """
        SELECT 's' || (user_id % 2) AS source, user_id AS id_data,
               CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN 'I' ELSE 'U' END AS last_action,
               ts AS meta_last_action_date FROM events""",
    "run_log": """
        SELECT event_id AS id, 'src' || (user_id % 5) AS source, 'data' AS controler,
               CASE WHEN event_type = 'signup' THEN 'full' ELSE 'update' END AS xfer_type,
               CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'importing data' END AS xfer_status,
               ts AS xfer_start_ts, CAST(floor(value) AS BIGINT) AS api_count_items, props AS xfer_filters
        FROM events""",
}


def actor_sql() -> str:
    """One actor as JSON, over a bridge `b` joined with organisms `g`, roles `r` and codes `n`."""
    return """json_object(
        'type_role', CASE WHEN b.id_organism IS NOT NULL THEN 'organism' WHEN b.id_role IS NOT NULL THEN 'role' END,
        'uuid_actor', coalesce(g.uuid_organisme, r.uuid_role),
        'cd_nomenclature_actor_role', n.cd_nomenclature,
        'identity', CASE WHEN b.id_organism IS NOT NULL THEN json_object('organism_name', g.nom_organisme)
                         WHEN b.id_role IS NOT NULL THEN json_object('first_name', r.nom_role, 'last_name', r.prenom_role) END,
        'email', coalesce(g.email_organisme, r.email))"""


ACTOR_JOINS = """
    LEFT JOIN organisms g ON b.id_organism = g.id_organisme
    LEFT JOIN roles r ON b.id_role = r.id_role
    JOIN codes n ON b.id_nomenclature_actor_role = n.id_nomenclature"""


def with_views(names: str, body: str, more: str = "") -> str:
    """Query text: the named views, further common tables, then the body."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in names.split()]
    if more:
        parts.append(more)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _actor_arrays(bridge: str, owner: str) -> str:
    return f"SELECT b.{owner}, CAST({actor_sql()} AS VARCHAR) AS actor FROM {bridge} b {ACTOR_JOINS}"


def code_joins(fact: str, codes, prefix: str = "n") -> str:
    return "\n".join(
        f"LEFT JOIN codes {prefix}_{c.key} ON {fact}.{c.column} = {prefix}_{c.key}.id_nomenclature" for c in codes
    )


EXPORT_COLUMNS = ", ".join(
    ["f.id_synthese", "f.entity_source_pk_value AS id_source", "f.unique_id_sinp AS id_perm_sinp"]
    + [
        (stamp_sql(f"f.{name}") if kind == "date" else f"f.{name}") + f" AS {key}"
        for name, key, kind in S.PLAIN
    ]
    + [stamp_sql("coalesce(f.meta_update_date, f.meta_create_date)") + " AS derniere_action"]
    + ["f.cd_hab AS code_habitat", "h.lb_hab_fr AS habitat"]
    + ["f.additional_data AS donnees_additionnelles", "f.the_geom_4326 AS wkt_4326"]
    + [f"n_{c.key}.cd_nomenclature AS {c.key}" for c in S.CODES]
)
EXPORT_JOINS = "LEFT JOIN habitats h ON h.cd_hab = f.cd_hab\n" + code_joins("f", S.CODES)

DATASET_VIEWS = (
    "codes datasets organisms roles dataset_actors dataset_territories protocols dataset_protocols"
)
FRAMEWORK_VIEWS = (
    "codes frameworks organisms roles framework_actors framework_territories framework_objectives"
    " framework_themes framework_publications publications"
)
_PROTOCOL = """json_object('uuid', p.unique_protocol_id, 'name', p.protocol_name, 'desc', p.protocol_desc,
                           'url', p.protocol_url, 'type', n.cd_nomenclature)"""
_PROTOCOLS = f"""SELECT dp.id_dataset, CAST({_PROTOCOL} AS VARCHAR) AS protocol
    FROM dataset_protocols dp JOIN protocols p USING (id_protocol)
    LEFT JOIN codes n ON p.id_nomenclature_protocol_type = n.id_nomenclature"""


def _dataset_doc(protocols: str, territories: str, actors: str) -> str:
    return f"""CAST(json_object('uuid', d.unique_dataset_id, 'name', d.dataset_name, 'desc', d.dataset_desc,
        'shortname', d.dataset_shortname, 'data_type', n_data_type.cd_nomenclature, 'keywords', d.keywords,
        'marine_domain', d.marine_domain, 'terrestrial_domain', d.terrestrial_domain,
        'collecting_method', n_collecting_method.cd_nomenclature, 'protocols', CAST({protocols} AS JSON),
        'data_origin', n_data_origin.cd_nomenclature, 'dataset_objectif', n_dataset_objectif.cd_nomenclature,
        'resource_type', n_resource_type.cd_nomenclature, 'source_status', n_source_status.cd_nomenclature,
        'territories', to_json({territories}), 'actors', CAST({actors} AS JSON)) AS VARCHAR)"""


DATASET_DOCS = f"""
    act AS ({_actor_arrays("dataset_actors", "id_dataset")}),
    acts AS (SELECT id_dataset, '[' || string_agg(actor, ',' ORDER BY actor) || ']' AS actors FROM act GROUP BY id_dataset),
    ter AS (SELECT t.id_dataset, list(DISTINCT c.cd_nomenclature ORDER BY c.cd_nomenclature NULLS LAST) AS territories
            FROM dataset_territories t LEFT JOIN codes c ON t.id_nomenclature_territory = c.id_nomenclature GROUP BY t.id_dataset),
    pro AS (SELECT id_dataset, '[' || string_agg(DISTINCT protocol, ',' ORDER BY protocol) || ']' AS protocol
            FROM ({_PROTOCOLS}) GROUP BY id_dataset),
    ds AS (SELECT d.id_dataset, d.id_acquisition_framework,
                  {_dataset_doc("pro.protocol", "coalesce(ter.territories, [CAST(NULL AS VARCHAR)])", "acts.actors")} AS jdd_data
           FROM datasets d JOIN acts USING (id_dataset) LEFT JOIN ter USING (id_dataset) LEFT JOIN pro USING (id_dataset)
           {code_joins("d", S.DATASET_CODES)})"""

# All the bridges joined at once, as a publisher's view does it.
DATASET_DOCS_FANOUT = f"""
    act AS ({_actor_arrays("dataset_actors", "id_dataset")}),
    pro AS ({_PROTOCOLS}),
    fan AS (SELECT d.id_dataset, pro.protocol,
                   list(DISTINCT c.cd_nomenclature ORDER BY c.cd_nomenclature NULLS LAST) AS territories,
                   '[' || string_agg(act.actor, ',' ORDER BY act.actor) || ']' AS actors
            FROM datasets d JOIN act USING (id_dataset)
            LEFT JOIN dataset_territories t USING (id_dataset)
            LEFT JOIN codes c ON t.id_nomenclature_territory = c.id_nomenclature
            LEFT JOIN pro USING (id_dataset)
            GROUP BY d.id_dataset, pro.protocol),
    ds AS (SELECT d.id_dataset, d.id_acquisition_framework,
                  {_dataset_doc("fan.protocol", "fan.territories", "fan.actors")} AS jdd_data
           FROM datasets d JOIN fan USING (id_dataset) {code_joins("d", S.DATASET_CODES)})"""


def _codes_agg(name: str, bridge: str, column: str) -> str:
    return f"""{name} AS (SELECT b.id_acquisition_framework,
        list(DISTINCT c.cd_nomenclature ORDER BY c.cd_nomenclature NULLS LAST) AS codes
        FROM {bridge} b LEFT JOIN codes c ON b.{column} = c.id_nomenclature GROUP BY b.id_acquisition_framework)"""


FRAMEWORK_DOCS = f"""
    af_act AS ({_actor_arrays("framework_actors", "id_acquisition_framework")}),
    af_acts AS (SELECT id_acquisition_framework, '[' || string_agg(actor, ',' ORDER BY actor) || ']' AS actors
                FROM af_act GROUP BY id_acquisition_framework),
    {_codes_agg("af_ter", "framework_territories", "id_nomenclature_territory")},
    {_codes_agg("af_obj", "framework_objectives", "id_nomenclature_objectif")},
    {_codes_agg("af_the", "framework_themes", "id_nomenclature_voletsinp")},
    af_pub AS (SELECT id_acquisition_framework, '[' || string_agg(DISTINCT doc, ',' ORDER BY doc) || ']' AS docs
               FROM (SELECT b.id_acquisition_framework,
                            CAST(json_object('uuid', p.unique_publication_id, 'reference', p.publication_reference,
                                             'url', p.publication_url) AS VARCHAR) AS doc
                     FROM framework_publications b LEFT JOIN publications p USING (id_publication))
               GROUP BY id_acquisition_framework),
    af AS (SELECT a.id_acquisition_framework, CAST(json_object(
        'uuid', a.unique_acquisition_framework_id, 'name', a.acquisition_framework_name,
        'desc', a.acquisition_framework_desc, 'start_date', CAST(a.acquisition_framework_start_date AS VARCHAR),
        'end_date', a.acquisition_framework_end_date, 'initial_closing_date', a.initial_closing_date,
        'territories', to_json(af_ter.codes), 'territorial_level', n_territorial_level.cd_nomenclature,
        'territory_desc', a.territory_desc, 'objectives', to_json(af_obj.codes),
        'publications', CAST(af_pub.docs AS JSON), 'financing_type', n_financing_type.cd_nomenclature,
        'target_description', a.target_description, 'ecologic_or_geologic_target', a.ecologic_or_geologic_target,
        'sinp_theme', to_json(af_the.codes), 'actors', CAST(af_acts.actors AS JSON),
        'is_parent', a.is_parent, 'parent_uuid', p.unique_acquisition_framework_id) AS VARCHAR) AS ca_data
        FROM frameworks a
        LEFT JOIN frameworks p ON p.id_acquisition_framework = a.acquisition_framework_parent_id
        JOIN af_acts ON af_acts.id_acquisition_framework = a.id_acquisition_framework
        LEFT JOIN af_ter ON af_ter.id_acquisition_framework = a.id_acquisition_framework
        LEFT JOIN af_obj ON af_obj.id_acquisition_framework = a.id_acquisition_framework
        LEFT JOIN af_the ON af_the.id_acquisition_framework = a.id_acquisition_framework
        LEFT JOIN af_pub ON af_pub.id_acquisition_framework = a.id_acquisition_framework
        {code_joins("a", S.FRAMEWORK_CODES)})"""
