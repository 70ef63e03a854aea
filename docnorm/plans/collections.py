"""The eight source collections as declarative specs: 55 target tables.

Column names, target types and keys are fixed facts of the target model; every value
rule is one of the ``spec`` rules (g, d, ct, sub, ts, jt, jv, ...). Policies:
first (ON CONFLICT DO NOTHING), last (DO UPDATE), first_batched (per-batch last wins,
then first wins across batches), strict (plain INSERT: duplicates go to rejects),
none (no unique key).
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values as V
from ..operators.validate import Reference
from . import spec as S
from .spec import FK, Col, Collection, ParentRule, Table

STR, INT, BOOL, TS, JSON, NUM = "string", "int", "boolean", "timestamp_ntz", "variant", "decimal(38,10)"

CU = Col("created_by_user_id", S.audit("created_by_user_id"))
UU = Col("updated_by_user_id", S.audit("updated_by_user_id"))
USERS_FK = (FK(("created_by_user_id",), "lml_users.main"), FK(("updated_by_user_id",), "lml_users.main"))


def C(name, fn, dtype=STR, n=None, nn=False) -> Col:
    return Col(name, fn, dtype, n, nn)


def catalog(name, path, cols, policy="last") -> Table:
    return Table(name, S.catalog_object(path), tuple(cols), key=("id",), policy=policy, catalog=True)


def _user_text(c):
    return V.user_id(c.item)


def _has_user(c):
    return V.is_object(c.item) & V.user_id(c.item).isNotNull()


def _ts_or_run(path):
    return lambda c: F.coalesce(V.ts_at(c.doc, path), c.run_ts)


def _updated_or_created(path, created):
    return lambda c: F.coalesce(V.ts_at(c.doc, path), F.coalesce(V.ts_at(c.doc, created), c.run_ts))


# --------------------------------------------------------------------------- users
USERS = Collection("lml_users", "users", truth_source=True, audit=(), tables=(
    Table("main", S.main_rows(), (
        C("id", S.oid(), n=255), C("firstname", S.g("firstname"), n=255, nn=True),
        C("lastname", S.g("lastname"), n=255, nn=True), C("username", S.g("username"), n=255),
        C("email", S.g("email"), n=255, nn=True), C("password", S.g("password"), n=500),
        C("role_id", S.sub("role", "id"), n=255), C("area_id", S.sub("area", "id"), n=255),
        C("subarea_id", S.sub("subarea", "id"), n=255), C("position_id", S.sub("position", "id"), n=255),
        C("signaturetype_id", S.sub("signaturetype", "id"), n=255),
        C("customer_id", S.ct("customer_id", "customerId"), n=255), C("deleted", S.d("deleted", False), BOOL),
        C("user_type", S.ct("userType", "useerType"), n=50), C("license_status", S.ct("license_status", "licenseStatus"), n=50),
        C("signature", S.g("signature")), C("dni", S.g("dni"), n=50),
        C("lumbre_version", S.ct("lumbre_version", "lumbreVersion"), INT),
        C("created_at", S.ts_fb("createdAt", "created_at"), TS), C("updated_at", S.ts_fb("updatedAt", "updated_at"), TS),
        C("updated_by_user_id", S.g("updatedBy.user.id"), n=255), C("__v", S.g("__v"), INT),
    ), key=("id",), policy="first_batched", fks=(
        FK(("role_id",), "lml_users.roles"), FK(("area_id",), "lml_users.areas"), FK(("subarea_id",), "lml_users.subareas"),
        FK(("position_id",), "lml_users.positions"), FK(("signaturetype_id",), "lml_users.signaturetypes"))),
    catalog("roles", "role", [C("id", S.str_id("id"), n=255), C("name", S.g("name"), n=500, nn=True)]),
    catalog("areas", "area", [C("id", S.str_id("id"), n=255), C("name", S.g("name"), n=500, nn=True),
                              C("descripcion", S.g("descripcion"))]),
    catalog("subareas", "subarea", [C("id", S.str_id("id"), n=255), C("name", S.g("name"), n=500, nn=True)]),
    catalog("positions", "position", [C("id", S.str_id("id"), n=255), C("name", S.g("name"), n=500, nn=True)]),
    catalog("signaturetypes", "signaturetype", [C("id", S.str_id("id"), n=255), C("name", S.g("name"), n=500, nn=True),
                                                C("descripcion", S.g("descripcion"))]),
))

# --------------------------------------------------------------------------- usersgroups
USERSGROUPS = Collection("lml_usersgroups", "usersgroups", depends=("users",), ghosts="groups", tables=(
    Table("main", S.main_rows(), (
        C("id", S.oid(), n=255), C("name", S.g("name"), n=500, nn=True), C("alias", S.g("alias"), n=500, nn=True),
        C("deleted", S.d("deleted", False), BOOL), C("customer_id", S.ct("customer_id", "customerId"), n=255),
        C("lumbre_version", S.ct("lumbre_version", "lumbreVersion"), INT),
        C("imported_from_external", S.ct("imported_from_external", "importedFromExternal"), BOOL),
        C("created_at", S.ts("createdAt"), TS), C("updated_at", S.ts("updatedAt"), TS), CU, UU,
        C("__v", S.g("__v"), INT),
    ), key=("id",), policy="first"),
    Table("members", S.truthy_items("users"), (
        C("group_id", S.parent(), n=255), C("user_id", S.item_str(), n=255),
    ), key=("group_id", "user_id"), policy="strict", sync_by=("group_id",),
        parents=(ParentRule("user_id", "lml_users.main"),), fks=(FK(("user_id",), "lml_users.main", on_delete="cascade"),)),
))

# --------------------------------------------------------------------------- processes
PROCESSES = Collection("lml_processes", "processes", depends=("users", "processtypes"), ghosts="standard", tables=(
    Table("main", S.main_rows(), (
        C("process_id", S.oid(), n=255), C("process_number", S.g("processNumber"), n=255),
        C("process_type_name", S.g("processTypeName"), n=255), C("process_address", S.g("processAddress")),
        C("process_type_id", S.g("processTypeId"), n=255), C("customer_id", S.g("customerId"), n=255),
        C("deleted", S.g("deleted"), BOOL), C("created_at", S.ts("createdAt"), TS), C("updated_at", S.ts("updatedAt"), TS),
        C("process_date", S.raw_ts("processDate"), TS), C("lumbre_status_name", S.g("lumbreStatusName"), n=255),
        C("starter_id", S.sub("processStarter", "id"), n=255), C("starter_name", S.sub("processStarter", "name"), n=255),
        C("starter_type", S.sub("processStarter", "starterType"), n=50), CU, UU,
    ), key=("process_id",), policy="first", fks=USERS_FK),
    Table("movements", S.objects("movements"), (
        C("process_id", S.parent()), C("movement_at", S.raw_ts("at"), TS),
        C("destination_id", S.str_id("id"), n=255), C("destination_type", S.g("to"), n=50),
    )),
    Table("initiator_fields", S.map_objects("initiatorFields"), (
        C("process_id", S.parent()), C("field_key", S.key(), n=255), C("field_id", S.str_id("id"), n=255),
        C("field_name", S.g("name"), n=255),
    ), key=("process_id", "field_key"), policy="strict"),
    Table("process_documents", S.union({"external": "documents", "internal": "internalDocuments"}), (
        C("process_id", S.parent()), C("doc_type", S.tag(), n=50), C("document_id", S.str_id("id"), n=255),
    ), key=("process_id", "document_id"), policy="strict"),
    Table("last_movements", S.one("lastMovement"), (
        C("process_id", S.parent()), C("origin_user_id", S.g("origin.user.id"), n=255),
        C("origin_user_name", S.full_name("origin.user"), n=255),
        C("destination_user_id", S.g("destination.user.id"), n=255),
        C("destination_user_name", S.full_name("destination.user"), n=255),
        C("destination_area_name", S.g("destination.user.area.name"), n=255),
        C("destination_subarea_name", S.g("destination.user.subarea.name"), n=255),
    ), key=("process_id",), policy="strict"),
))


# --------------------------------------------------------------------------- listbuilder
def _fields(name, path):
    return Table(name, S.objects(path), (
        C("listbuilder_id", S.parent()), C("field_key", S.g("key"), n=255), C("field_label", S.g("label"), n=255),
        C("sortable", S.d("sortable", False), BOOL), C("field_order", S.pos(), INT),
    ), key=("listbuilder_id", "field_key", "field_order"), policy="strict")


def _search(name, path):
    return Table(name, S.strings(path), (
        C("listbuilder_id", S.parent()), C("field_name", S.item_str(), n=255), C("field_order", S.pos(), INT),
    ), key=("listbuilder_id", "field_name"), policy="strict")


LISTBUILDER = Collection("lml_listbuilder", "listbuilder", depends=("users",), ghosts="standard", tables=(
    Table("main", S.main_rows(), (
        C("listbuilder_id", S.oid(), n=255), C("alias", S.g("alias"), n=500), C("title_list", S.g("titleList"), n=500),
        C("gql_field", S.g("gqlField"), n=255), C("gql_query", S.g("gqlQuery")),
        C("gql_variables", S.jt("gqlVariables"), JSON),
        C("mode_table", S.flag("mode.table", True), BOOL), C("mode_map", S.flag("mode.map", False), BOOL),
        C("lumbre_internal", S.d("lumbreInternal", False), BOOL), C("lumbre_version", S.g("lumbreVersion"), INT),
        C("selectable", S.g("selectable"), BOOL), C("items_per_page", S.g("itemsPerPage"), INT), C("page", S.g("page"), INT),
        C("soft_permissions", S.jt("softPermissions"), JSON), C("aggs", S.jt("aggs"), JSON),
        C("meta_search", S.jt("metaSearch"), JSON), C("mode_box_options", S.jt("modeBoxOptions"), JSON),
        C("created_at", S.ts("createdAt"), TS), C("updated_at", S.ts("updatedAt"), TS), CU, UU,
        C("customer_id", S.g("customerId"), n=255), C("mongo_version", S.g("__v"), INT),
    ), key=("listbuilder_id",), policy="strict", fks=USERS_FK),
    _fields("fields", "fields"),
    _fields("available_fields", "allAvailableFields"),
    Table("items", S.truthy_id("items", "name"), (
        C("listbuilder_id", S.parent()), C("item_name", S.g("name"), n=255), C("item_order", S.pos(), INT),
    ), key=("listbuilder_id", "item_name"), policy="strict"),
    Table("button_links", S.objects("buttonLinks"), (
        C("listbuilder_id", S.parent()), C("button_value", S.g("value"), n=255), C("button_to", S.g("to"), n=500),
        C("button_class", S.g("buttonClass"), n=100),
        C("endpoint_to_validate_visibility", S.g("endpointToValidateVisibility"), n=500),
        C("show_button", S.d("show", True), BOOL), C("disabled", S.d("disabled", False), BOOL),
        C("button_order", S.pos(), INT),
    )),
    Table("path_actions", S.objects("lmPathActions"), (
        C("listbuilder_id", S.parent()), C("action_to", S.g("to"), n=500), C("tooltip", S.g("tooltip"), n=255),
        C("font_awesome_icon", S.g("fontAwesomeIcon"), n=100), C("action_order", S.pos(), INT),
    )),
    _search("search_fields_selected", "searchOnFieldsSelected"),
    _search("search_fields_to_selected", "searchOnFieldsToSelected"),
    Table("privileges", S.objects("privileges"), (
        C("listbuilder_id", S.parent()), C("privilege_id", S.str_id("id"), n=255),
        C("privilege_name", S.g("name"), n=255), C("privilege_code", S.g("codigo_privilegio"), n=100),
    ), key=("listbuilder_id", "privilege_id"), policy="strict"),
))


# --------------------------------------------------------------------------- formbuilder
def _allow(name, path):
    return Table(name, S.objects(path), (
        C("formbuilder_id", S.parent()), C("privilege_id", S.str_id("id"), n=255), C("name", S.g("name")),
        C("codigo_privilegio", S.g("codigo_privilegio")),
    ), key=("formbuilder_id", "privilege_id"), policy="strict")


FORMBUILDER = Collection("lml_formbuilder", "formbuilder", depends=("users",), ghosts="standard", tables=(
    Table("main", S.main_rows(), (
        C("formbuilder_id", S.oid(), n=255), C("alias", S.g("alias"), n=500), C("page_title_data", S.g("pageTitleData"), n=500),
        C("message_after_post_or_put", S.g("messageAfterPOSTorPUT")),
        C("path_to_redirect_after_post_or_put", S.g("pathToRedirectAfterPOSTorPUT")),
        C("api_rest_for_handle_all_http_methods", S.g("apiRestForHandleAllHttpMethods")),
        C("validations", S.jt("validations"), JSON), C("conditionals", S.jt("conditionals"), JSON),
        C("soft_permissions", S.jt("softPermissions"), JSON), C("lumbre_internal", S.d("lumbreInternal", False), BOOL),
        C("lumbre_version", S.g("lumbreVersion"), INT), C("created", S.ts("created"), TS),
        C("created_at", S.ts("createdAt"), TS), C("updated_at", S.ts("updatedAt"), TS),
        C("customer_id", S.g("customerId"), n=255), CU, UU, C("mongo_version", S.g("__v"), INT),
    ), key=("formbuilder_id",), policy="first", fks=USERS_FK),
    Table("elements", S.objects("formElements"), (
        C("formbuilder_id", S.parent()), C("element_id", S.g("id"), NUM), C("component_name", S.g("componentName"), n=100),
        C("form_object_to_send_to_server_property", S.g("formObjectToSendToServerProperty"), n=255),
        C("class_name", S.g("class"), n=100), C("component_props", S.jt("componentProps"), JSON),
        C("component_permissions", S.jt("componentPermissions"), JSON),
        C("visibility_depend_on_conditions", S.jt("visibilityDependOnConditions"), JSON),
        C("actions", S.jt("actions"), JSON), C("validations", S.jt("validations"), JSON),
        C("is_hidden_on_pdf", S.g("isHiddenOnPdf"), BOOL), C("has_label_on_pdf", S.g("hasLabelOnPdf"), BOOL),
        C("order_index", S.pos(), INT),
    )),
    _allow("allow_access", "allowAccess"), _allow("allow_create", "allowCreate"), _allow("allow_update", "allowUpdate"),
))


# --------------------------------------------------------------------------- processtypes
def _pt_catalog(name, path):
    return Table(name, S.truthy_id(path), (C("id", S.str_id("id"), n=255), C("name", S.d("name", ""), n=255, nn=True)),
                 key=("id",), policy="first_batched", catalog=True)


def _pt_relation(name, path, col, parent_table):
    return Table(name, S.truthy_id(path), (C("processtype_id", S.parent()), C(col, S.str_id("id"), n=255)),
                 key=("processtype_id", col), policy="first", fks=(FK((col,), parent_table),))


def _actions(name, path, what, catalog_table, with_role=True):
    cols = [C("processtype_id", S.parent()), C(f"{what}_id", S.str_id("id"), n=255), C(f"{what}_name", S.g("name"), n=500)]
    rules = [ParentRule(f"{what}_id", catalog_table)]
    if with_role:
        cols += [C("role_id", S.g("role.id"), n=255), C("action", S.g("action"), n=10)]
        rules.append(ParentRule("role_id", "lml_users.roles", action="null"))
    return Table(name, S.objects(path), tuple(cols), key=("processtype_id", f"{what}_id"), policy="first",
                 parents=tuple(rules))


PROCESSTYPES = Collection("lml_processtypes", "processtypes", depends=("users",), ghosts="processtypes", tables=(
    Table("main", S.main_rows(), (
        C("processtype_id", S.oid(), n=255), C("type_name", S.g("typeName"), n=255, nn=True),
        C("type_alias", S.g("typeAlias"), n=255), C("type_description", S.g("typeDescription")),
        C("type_numerator", S.g("typeNumerator"), n=50), C("type_comments", S.g("typeComments"), n=50),
        C("type_can_be_taken", S.g("typeCanBeTaken"), n=50),
        C("type_can_be_taken_detail", S.g("typeCanBeTakenDetail"), n=255),
        C("type_hide_comments_on_finished", S.g("typeHideCommentsOnFinished"), BOOL),
        C("tad_available", S.g("tadAvailable"), BOOL), C("tad_url", S.g("tadUrl"), n=500),
        C("is_editable", S.g("isEditable"), BOOL), C("published", S.g("published"), BOOL),
        C("deleted", S.g("deleted"), BOOL), C("user_who_associated_can_correct", S.g("userWhoAssociatedCanCorrect"), BOOL),
        C("lumbre_version", S.g("lumbreVersion"), INT), C("_master", S.g("_master"), n=255), C("__v", S.g("__v"), INT),
        C("_v", S.g("_v"), INT), C("listbuilder_id", S.g("listbuilderId"), n=255),
        C("formbuilder_id", S.g("formbuilderId"), n=255), C("customer_id", S.g("customerId"), n=255),
        C("type_prefix_id", S.sub("typePrefix", "id"), n=255),
        C("type_correction_role_id", S.sub("typeCorrection", "id"), n=255),
        C("type_reopen_role_id", S.sub("typeReOpen", "id"), n=255),
        C("calculated_props", S.jt("calculatedProps"), JSON),
        C("contenttemplate_conditionals", S.jt("contenttemplateConditionals"), JSON),
        C("process_fields_validations", S.jt("processFieldsValidations"), JSON), C("suggest", S.jt("suggest"), JSON),
        CU, UU, C("created_at", S.ts("createdAt"), TS), C("updated_at", S.ts("updatedAt"), TS),
    ), key=("processtype_id",), policy="first", fks=USERS_FK + (
        FK(("type_prefix_id",), "lml_processtypes.type_prefixes"), FK(("type_correction_role_id",), "lml_users.roles"),
        FK(("type_reopen_role_id",), "lml_users.roles"))),
    Table("type_prefixes", S.catalog_object("typePrefix"), (
        C("id", S.str_id("id"), n=255), C("name", S.d("name", ""), n=255, nn=True)),
        key=("id",), policy="first_batched", catalog=True),
    _pt_catalog("people_types", "instanceStarters.peopleTypes"),
    _pt_relation("starter_people_types", "instanceStarters.peopleTypes", "people_type_id", "lml_processtypes.people_types"),
    _pt_catalog("initiator_types", "instanceStarters.initiatorTypes"),
    _pt_relation("starter_initiator_types", "instanceStarters.initiatorTypes", "initiator_type_id",
                 "lml_processtypes.initiator_types"),
    _actions("instance_actions_area", "instanceActions.area", "area", "lml_users.areas"),
    _actions("instance_actions_subarea", "instanceActions.subarea", "subarea", "lml_users.subareas"),
    _actions("instance_actions_edit_area", "instanceActionsEdit.area", "area", "lml_users.areas", with_role=False),
    _actions("instance_actions_edit_subarea", "instanceActionsEdit.subarea", "subarea", "lml_users.subareas",
             with_role=False),
    _actions("instance_actions_edit_role", "instanceActionsEdit.role", "role", "lml_users.roles", with_role=False),
    Table("process_fields", S.objects("processFields"), (
        C("processtype_id", S.parent()), C("field_id", S.str_id("id"), n=255), C("field_order", S.pos(), INT),
        C("class", S.g("class"), n=100), C("component_name", S.g("componentName"), n=100),
        C("form_property", S.g("formObjectToSendToServerProperty"), n=255),
        C("is_hidden_on_pdf", S.g("isHiddenOnPdf"), BOOL), C("has_label_on_pdf", S.g("hasLabelOnPdf"), BOOL),
        C("component_props", S.jt("componentProps"), JSON), C("component_permissions", S.jt("componentPermissions"), JSON),
        C("visibility_conditions", S.jt("visibilityDependOnConditions"), JSON),
    ), key=("processtype_id", "field_id"), policy="first"),
))

# --------------------------------------------------------------------------- people
# People dynamic-field keys.
PEOPLE_DYNAMIC_KEYS = ("_3", "_4", "_5", "_6", "_7")

PEOPLE = Collection("lml_people", "people", depends=("users",), ghosts="standard", tables=(
    Table("main", S.main_rows(), (
        C("people_id", S.oid(), n=255), C("people_type_id", S.g("peopleTypeId"), n=255, nn=True),
        C("person_id_type_id", S.sub("personIdType", "id"), n=255, nn=True),
        C("person_name", S.g("personName"), n=255, nn=True), C("person_email", S.g("personEmail"), n=255),
        C("person_id", S.g("personId"), n=255, nn=True), C("domicilio_humana", S.g("domicilio_0"), n=500),
        C("piso_humana", S.g("piso_1"), n=50), C("departamento_humana", S.g("departamento_2"), n=50),
        C("tipo_persona_juridica", S.g("tipo_de_persona_juridica_0"), n=100),
        C("tipo_asociacion", S.g("tipo_de_asociacion_1"), n=100), C("tipo_organismo", S.g("tipo_de_organismo_2"), n=100),
        C("tipo_sociedad", S.g("tipo_de_sociedad_3"), n=100), C("direccion_juridica", S.g("direccion_4"), n=500),
        C("dynamic_fields", S.dynamic_fixed(PEOPLE_DYNAMIC_KEYS), JSON), C("people_content", S.g("peopleContent")),
        C("customer_id", S.g("customerId"), n=255), Col("created_by_user_id", S.audit("created_by_user_id"), STR, 255, True),
        Col("updated_by_user_id", S.audit("updated_by_user_id"), STR, 255, True),
        C("created_at", _ts_or_run("createdAt"), TS, nn=True),
        C("updated_at", _updated_or_created("updatedAt", "createdAt"), TS, nn=True),
        C("deleted", S.d("deleted", False), BOOL), C("lumbre_version", S.g("lumbreVersion"), INT), C("__v", S.g("__v"), INT),
    ), key=("people_id",), policy="first", fks=USERS_FK + (
        FK(("people_type_id",), "lml_people.people_types"), FK(("person_id_type_id",), "lml_people.person_id_types"))),
    Table("people_types", S.Rows("object", None, where=lambda c: V.truthy(V.at(c.item, "peopleTypeId"))), (
        C("id", S.str_id("peopleTypeId"), n=255), C("name", S.g("peopleTypeName"), n=255, nn=True),
        C("alias", S.g("peopleTypeAlias"), n=255, nn=True),
    ), key=("id",), policy="last", catalog=True),
    catalog("person_id_types", "personIdType", [C("id", S.str_id("id"), n=255), C("name", S.g("name"), n=255, nn=True)]),
))


# --------------------------------------------------------------------------- documents
def _people(name, path, key, with_action=True):
    cols = [C("document_id", S.parent()), C("user_id", S.str_id("id"), n=255), C("user_name", S.g("name"), n=500)]
    if with_action:
        cols.append(C("action", S.g("action"), n=10))
    return Table(name, S.truthy_id(path), tuple(cols), key=key, policy="first")


def _entities(name, container, branches, tags_as_is=False):
    tags = {(b if tags_as_is else V.singular(b)): f"{container}.{b}" for b in branches}
    return Table(name, S.union(tags, where=lambda c: V.is_object(c.item) & V.truthy_at(c.item, "id")), (
        C("document_id", S.parent()), C("entity_type", S.tag(), n=20, nn=True),
        C("entity_id", S.str_id("id"), n=255, nn=True), C("entity_name", S.g("name"), n=500),
    ), key=("document_id", "entity_type", "entity_id"), policy="first")


DOCUMENTS = Collection("lml_documents", "documents", depends=("users",), ghosts="standard", tables=(
    Table("main", S.main_rows(), (
        C("document_id", S.oid(), n=255), C("document_number", S.g("documentNumber"), n=255),
        C("document_name", S.g("documentName"), n=500), C("document_content", S.g("documentContent")),
        C("document_type_id", S.g("documentTypeId"), n=255), C("document_type_name", S.g("documentTypeName"), n=255),
        C("document_type_alias", S.g("documentTypeAlias"), n=255),
        C("document_type_numerator", S.g("documentTypeNumerator"), n=100),
        C("document_type_signature", S.g("documentTypeSignature"), n=100),
        C("document_type_visibility", S.g("documentTypeVisibility"), n=50),
        C("document_type_comunicable", S.g("documentTypeComunicable"), n=50),
        C("type_prefix_id", S.sub("documentTypePrefix", "id"), n=255),
        C("type_prefix_name", S.sub("documentTypePrefix", "name"), n=100),
        C("status_id", S.sub("lumbreStatus", "id"), n=50), C("status_name", S.sub("lumbreStatus", "name"), n=100),
        C("lumbre_total_signers", S.d("lumbreTotalSigners", 0), INT),
        C("lumbre_total_participants", S.d("lumbreTotalParticipants", 0), INT),
        C("lumbre_total_reviewers", S.g("lumbreTotalReviewers"), INT), C("lumbre_progress", S.d("lumbreProgress", 0), INT),
        C("lumbre_completed_signatures", S.d("lumbreCompletedSignatures", 0), INT),
        C("lumbre_completed_participants", S.d("lumbreCompletedParticipants", 0), INT),
        C("lumbre_completed_reviews", S.d("lumbreCompletedReviews", 0), INT),
        C("deleted", S.d("deleted", False), BOOL), C("has_external_signers", S.d("hasExternalSigners", False), BOOL),
        C("pdf_num_pages", S.g("pdfNumPages"), INT), C("pdf_size", S.g("pdfSize"), INT),
        C("lumbre_version", S.d("lumbreVersion", 1), INT),
        C("everyone_can_access", S.flag("calculatedProps.everyoneCanAccess", True), BOOL),
        C("signer_reviewer_id", S.sub("lumbreSignerReviewer", "id"), n=255),
        C("signer_reviewer_name", S.sub("lumbreSignerReviewer", "name"), n=500),
        C("signer_reviewer_done", S.sub("lumbreSignerReviewer", "done"), BOOL),
        C("substitute_id", S.sub("lumbreSubstitute", "id"), n=255),
        C("substitute_name", S.sub("lumbreSubstitute", "name"), n=500),
        C("signer_position_map", S.jv("signerPositionMap"), JSON), C("dynamic_fields", S.dynamic_regex(), JSON),
        C("created_at", S.ts("createdAt"), TS), C("updated_at", S.ts("updatedAt"), TS),
        C("document_date", S.ts("documentDate"), TS), C("last_movement_date", S.ts("lastMovementDate"), TS),
        C("customer_id", S.g("customerId"), n=255), CU, UU, C("__v", S.g("__v"), INT),
    ), key=("document_id",), policy="first", fks=USERS_FK),
    _people("participants", "participants", ("document_id", "user_id", "action")),
    _people("signers", "signers", ("document_id", "user_id")),
    _people("reviewers", "reviewers", ("document_id", "user_id")),
    _people("share_with", "shareWith", ("document_id", "user_id"), with_action=False),
    Table("movements", S.objects("movements"), (
        C("document_id", S.parent()), C("created_at", S.ts("created_at"), TS),
        C("created_by_user_id", S.str_id("created_by.id"), n=255),
        C("created_by_user_name", S.name_of("created_by"), n=500),
        C("movement_data", S.jv("movement"), JSON), C("documentation", S.jv("documentation"), JSON),
    )),
    _entities("recipients", "recipients", ("users", "areas", "subareas", "groups")),
    Table("recipient_emails", S.Rows("array", "recipients.emails",
                                     where=lambda c: V.is_object(c.item) & V.truthy(V.at(c.item, "name"))), (
        C("document_id", S.parent()), C("email_id", S.str_id("id"), n=50), C("email", S.g("name"), n=500, nn=True),
    ), key=("document_id", "email"), policy="first"),
    _entities("viewers", "viewers", ("users", "areas", "subareas")),
    Table("steps", S.objects("documentSteps.items"), (
        C("document_id", S.parent()), C("position", S.dd("documentSteps.position", 0), INT),
        C("step_order", S.pos(), INT, nn=True), C("title", S.g("title"), n=255),
        C("description", S.g("description"), n=500), C("avatar", S.g("avatar"), n=500),
    ), reads_doc=True),
    _entities("instance_privileges", "instancePrivileges", ("area", "subarea", "role"), tags_as_is=True),
    Table("access", S.union({V.singular(b): f"calculatedProps.whoCanAccess.{b}" for b in ("users", "areas", "subareas")},
                            where=lambda c: V.truthy_at(c.item, "$")), (
        C("document_id", S.parent()), C("entity_type", S.tag(), n=20, nn=True),
        C("entity_id", S.item_str(), n=255, nn=True),
    ), key=("document_id", "entity_type", "entity_id"), policy="first"),
    Table("next_workflow", S.unpivot({"signer": "lumbreNextSigner", "participant": "lumbreNextParticipant",
                                      "reviewer": "lumbreNextReviewer"}, where=_has_user), (
        C("document_id", S.parent()), C("workflow_type", S.tag(), n=20, nn=True), C("user_id", _user_text, n=255),
        C("firstname", S.g("firstname"), n=255), C("lastname", S.g("lastname"), n=255), C("email", S.g("email"), n=255),
        C("user_type", S.g("userType"), n=50), C("user_initials", S.g("userInitials"), n=10),
        C("profile_picture", S.g("profilePicture"), n=500), C("role_id", S.sub("role", "id"), n=255),
        C("role_name", S.sub("role", "name"), n=255), C("area_id", S.sub("area", "id"), n=255),
        C("area_name", S.sub("area", "name"), n=255), C("subarea_id", S.sub("subarea", "id"), n=255),
        C("subarea_name", S.sub("subarea", "name"), n=255), C("position_id", S.sub("position", "id"), n=255),
        C("position_name", S.sub("position", "name"), n=255), C("action", S.g("action"), n=50),
        C("signature", S.g("signature")), C("in_character_of", S.g("inCharacterOf"), n=255),
        C("reviewer_id", S.sub("reviewer", "id"), n=255), C("reviewer_name", S.sub("reviewer", "name"), n=500),
    ), key=("document_id", "workflow_type"), policy="first"),
))

COLLECTIONS = {c.source: c for c in (USERS, USERSGROUPS, LISTBUILDER, FORMBUILDER, PROCESSTYPES, PROCESSES, PEOPLE,
                                     DOCUMENTS)}


def table_count() -> int:
    return sum(len(c.tables) for c in COLLECTIONS.values())


def fk_edges() -> list[tuple[str, str]]:
    """(child, parent) table edges: declared FKs plus every child table -> its main."""
    edges = []
    for c in COLLECTIONS.values():
        for t in c.tables:
            child = f"{c.name}.{t.name}"
            for fk in t.fks:
                edges.append((child, fk.table))
            if t.name != "main" and not t.catalog:
                edges.append((child, f"{c.name}.main"))
    return edges


def foreign_keys() -> list[Reference]:
    """Every foreign key of the target model: the declared ones, those behind the parent rules,
    and that of each child table to its main table, whose rows take theirs along."""
    keys: dict[tuple[str, str], Reference] = {}
    for c in COLLECTIONS.values():
        for t in c.tables:
            child = f"{c.name}.{t.name}"
            found = [Reference(child, fk.columns[0], fk.table, fk.parent_columns[0], fk.on_delete) for fk in t.fks]
            found += [Reference(child, p.column, p.table, p.parent_column, "no action") for p in t.parents]
            if t.name != "main" and not t.catalog:
                found.append(Reference(child, t.cols[0].name, f"{c.name}.main", c.main.cols[0].name))
            for r in found:
                keys.setdefault((r.child, r.column), r)
    return list(keys.values())


def dependencies() -> dict[str, tuple[str, ...]]:
    return {name: c.depends for name, c in COLLECTIONS.items()}
