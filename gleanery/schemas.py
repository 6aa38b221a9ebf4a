"""Record layouts and the name tables that drive the operators.

The names below are an exchange format shared with the publishers, so they are
fixed values: export keys, target columns and code-list types.
"""

from __future__ import annotations

from typing import NamedTuple

# ---------------------------------------------------------------- fixed values
TYPE_WITH_METADATA = "synthese_with_metadata"
TYPE_WITH_LABEL = "synthese_with_label"
TYPE_WITH_CODES = "synthese_with_cd_nomenclature"
FACT_TYPES = (TYPE_WITH_LABEL, TYPE_WITH_CODES, TYPE_WITH_METADATA)
DEFAULT_DATA_TYPE = TYPE_WITH_CODES

LEVEL_FRAMEWORK = "acquisition framework"
LEVEL_DATASET = "dataset"

STATUS_INIT = "init"
STATUS_IMPORT = "importing data"
STATUS_DELETE = "delete"
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"

#: Kind of the runs that a poll logs, and the member of an item that says when it was changed.
STREAM = "stream"
CHANGED_AT = "derniere_action"
CONTROLER_DATA = "data"
CONTROLER_METADATA = "metadata"


class Code(NamedTuple):
    """One coded attribute: key in the item, column in the fact, code-list type."""

    key: str
    column: str
    list_type: str


# Coded attributes of an observation.
CODES = (
    Code("nature_objet_geo", "id_nomenclature_geo_object_nature", "NAT_OBJ_GEO"),
    Code("type_regroupement", "id_nomenclature_grp_typ", "TYP_GRP"),
    Code("comportement", "id_nomenclature_behaviour", "OCC_COMPORTEMENT"),
    Code("technique_obs", "id_nomenclature_obs_technique", "METH_OBS"),
    Code("statut_biologique", "id_nomenclature_bio_status", "STATUT_BIO"),
    Code("etat_biologique", "id_nomenclature_bio_condition", "ETA_BIO"),
    Code("naturalite", "id_nomenclature_naturalness", "NATURALITE"),
    Code("preuve_existante", "id_nomenclature_exist_proof", "PREUVE_EXIST"),
    Code("precision_diffusion", "id_nomenclature_diffusion_level", "NIV_PRECIS"),
    Code("stade_vie", "id_nomenclature_life_stage", "STADE_VIE"),
    Code("sexe", "id_nomenclature_sex", "SEXE"),
    Code("objet_denombrement", "id_nomenclature_obj_count", "OBJ_DENBR"),
    Code("type_denombrement", "id_nomenclature_type_count", "TYP_DENBR"),
    Code("niveau_sensibilite", "id_nomenclature_sensitivity", "SENSIBILITE"),
    Code("statut_observation", "id_nomenclature_observation_status", "STATUT_OBS"),
    Code("floutage_dee", "id_nomenclature_blurring", "DEE_FLOU"),
    Code("statut_source", "id_nomenclature_source_status", "STATUT_SOURCE"),
    Code("type_info_geo", "id_nomenclature_info_geo_type", "TYP_INF_GEO"),
    Code("methode_determination", "id_nomenclature_determination_method", "TYPE"),
    Code("statut_validation", "id_nomenclature_valid_status", "STATUT_VALID"),
)
# Fixed value: accepted on import, never exported.
BIOGEO = Code("statut_biogeo", "id_nomenclature_biogeo_status", "STAT_BIOGEO")
# Codes of the geographic information type (attached / referenced).
GEO_INFO_ATTACHED = "2"
GEO_INFO_REFERENCED = "1"

# Plain attributes as (fact column, export key, type on load).
PLAIN = (
    ("unique_id_sinp_grp", "id_perm_grp_sinp", "uuid"),
    ("cd_nom", "cd_nom", "int"),
    ("meta_v_taxref", "version_taxref", "string"),
    ("nom_cite", "nom_cite", "string"),
    ("count_min", "nombre_min", "int"),
    ("count_max", "nombre_max", "int"),
    ("altitude_min", "altitude_min", "int"),
    ("altitude_max", "altitude_max", "int"),
    ("depth_min", "profondeur_min", "int"),
    ("depth_max", "profondeur_max", "int"),
    ("observers", "observateurs", "string"),
    ("determiner", "determinateur", "string"),
    ("validator", "validateur", "string"),
    ("sample_number_proof", "numero_preuve", "string"),
    ("digital_proof", "preuve_numerique", "string"),
    ("non_digital_proof", "preuve_non_numerique", "string"),
    ("comment_context", "comment_releve", "string"),
    ("comment_description", "comment_occurrence", "string"),
    ("reference_biblio", "reference_biblio", "string"),
    ("place_name", "nom_lieu", "string"),
    ("precision", "precision", "int"),
    ("grp_method", "methode_regroupement", "string"),
    ("date_min", "date_debut", "date"),
    ("date_max", "date_fin", "date"),
)
VALIDATION_COMMENT = ("validation_comment", "comment_validation", "string")

# Coded attributes of the metadata documents.
DATASET_CODES = (
    Code("data_type", "id_nomenclature_data_type", "DATA_TYP"),
    Code("collecting_method", "id_nomenclature_collecting_method", "METHO_RECUEIL"),
    Code("data_origin", "id_nomenclature_data_origin", "DS_PUBLIQUE"),
    Code("dataset_objectif", "id_nomenclature_dataset_objectif", "JDD_OBJECTIFS"),
    Code("resource_type", "id_nomenclature_resource_type", "RESOURCE_TYP"),
    Code("source_status", "id_nomenclature_source_status", "STATUT_SOURCE"),
)
FRAMEWORK_CODES = (
    Code("territorial_level", "id_nomenclature_territorial_level", "NIVEAU_TERRITORIAL"),
    Code("financing_type", "id_nomenclature_financing_type", "TYPE_FINANCEMENT"),
)
TERRITORY_TYPE = "TERRITOIRE"
OBJECTIVE_TYPE = "CA_OBJECTIFS"
THEME_TYPE = "VOLET_SINP"
ACTOR_ROLE_TYPE = "ROLE_ACTEUR"
# Codes used where a framework document names none.
DEFAULT_TERRITORY = "METROP"
DEFAULT_OBJECTIVE = "11"
DEFAULT_THEME = "1"
# Texts used where a document has none.
BASIC_DATASET_DESC = "A compléter"
BASIC_FRAMEWORK_DESC = "Description of acquisition framework : "
DATASET_DESC = "..."

ALL_CODE_TYPES = tuple(
    dict.fromkeys(
        [c.list_type for c in (*CODES, BIOGEO, *DATASET_CODES, *FRAMEWORK_CODES)]
        + [TERRITORY_TYPE, OBJECTIVE_TYPE, THEME_TYPE, ACTOR_ROLE_TYPE]
    )
)

# --------------------------------------------------------------------- layouts
DATA_KEY = ["id_data", "source", "type"]
DATA_JSON = (
    "source string, controler string, type string, id_data bigint, uuid string,"
    " item string, update_ts timestamp_ntz, import_id bigint"
)
METADATA_JSON = (
    "source string, controler string, type string, level string, uuid string,"
    " item string, update_ts timestamp_ntz, import_id bigint"
)
IMPORT_LOG = (
    "id bigint, source string, controler string, xfer_type string, xfer_status string,"
    " xfer_start_ts timestamp_ntz, xfer_end_ts timestamp_ntz, api_count_items bigint,"
    " api_count_errors bigint, data_count_upserts bigint, data_count_delete bigint,"
    " data_count_errors bigint, metadata_count_upserts bigint, metadata_count_errors bigint,"
    " xfer_filters string, comment string"
)
IMPORT_LOG_COLUMNS = [c.split()[0] for c in IMPORT_LOG.split(",")]
ERROR_LOG = (
    "source string, uuid string, controler string, last_ts timestamp_ntz, item string,"
    " error string, import_id bigint"
)
ERROR_LOG_COLUMNS = [c.split()[0] for c in ERROR_LOG.split(",")]

# One delivered page: the elements stay text, so that unknown keys survive.
PAGE = "items array<string>, total_filtered bigint, total bigint, limit bigint"

ACTOR = (
    "type_role string, uuid_actor string, cd_nomenclature_actor_role string,"
    " identity struct<organism_name:string,first_name:string,last_name:string>, email string"
)
FRAMEWORK_DOC = (
    "uuid string, name string, `desc` string, start_date string, end_date string,"
    " ecologic_or_geologic_target string, financing_type string, territorial_level string,"
    " initial_closing_date string, target_description string, territories string,"
    " objectives string, voletsinp string, sinp_theme string, actors string"
)
DATASET_DOC = (
    "uuid string, ca_uuid string, name string, shortname string, `desc` string,"
    " marine_domain string, terrestrial_domain string, keywords string, territories string,"
    " actors string, " + ", ".join(f"{c.key} string" for c in DATASET_CODES)
)
# Every attribute is read as text first and cast one by one afterwards, so that a
# bad value can be told from a missing one.
ITEM_TEXT = ", ".join(
    f"{key} string"
    for key in dict.fromkeys(
        ["id_synthese", "id_perm_sinp", "ca_uuid", "ca_nom", "jdd_uuid", "jdd_nom"]
        + [key for _, key, _ in (*PLAIN, VALIDATION_COMMENT)]
        + [c.key for c in (*CODES, BIOGEO)]
        + ["label", "cd_hab", "code_habitat", "wkt_4326", "donnees_additionnelles"]
    )
) + ", area_attachment struct<type_code:string,area_code:string>"
