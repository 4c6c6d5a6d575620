"""Which table and which column plays which part.

Operators never spell out a table name: they ask the profile. The preset below
describes the schema the rule files are written for; another schema with the
same shape only needs another ``Profile``.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Named:
    """A metadata table: surrogate id plus the public uid that rules mention."""

    table: str
    key: str
    uid: str = "uid"


@dataclass(frozen=True)
class Fact:
    """A fact table. ``item`` says what a row is about, ``place`` where it was
    recorded; ``dependents`` hold further rows about the same ``key``."""

    table: str
    key: str
    item: str
    place: str
    document: str | None = None
    dependents: tuple[str, ...] = ()


@dataclass(frozen=True)
class Enrolment:
    """Which entity takes part in which program, and the tables that describe
    an entity."""

    table: str
    program: str
    entity: str
    entity_tables: tuple[str, ...]


@dataclass(frozen=True)
class Profile:
    dataset: Named
    element: Named
    dataset_element: str
    program: Named
    stage: str
    stage_key: str
    org_unit: Named
    path: str
    values: Fact
    events: Fact
    enrolment: Enrolment


# Table and column names of the schema the rules address.
HEALTH_RECORDS = Profile(
    dataset=Named("dataset", "datasetid"),
    element=Named("dataelement", "dataelementid"),
    dataset_element="datasetelement",
    program=Named("program", "programid"),
    stage="programstage",
    stage_key="programstageid",
    org_unit=Named("organisationunit", "organisationunitid"),
    path="path",
    values=Fact(
        table="datavalue",
        key="dataelementid",
        item="dataelementid",
        place="sourceid",
        dependents=("datavalueaudit",),
    ),
    events=Fact(
        table="programstageinstance",
        key="programstageinstanceid",
        item="programstageid",
        place="organisationunitid",
        document="eventdatavalues",
        dependents=("trackedentitydatavalueaudit", "programstageinstancecomments"),
    ),
    enrolment=Enrolment(
        table="programinstance",
        program="programid",
        entity="trackedentityinstanceid",
        entity_tables=(
            "trackedentityattributevalue",
            "trackedentityattributevalueaudit",
            "trackedentityinstance",
            "trackedentityprogramowner",
        ),
    ),
)

# The tables that hold recorded data, audits and messages.
DATA_TABLES = (
    "trackedentitydatavalueaudit",
    "trackedentitydatavalue",
    "datavalueaudit",
    "datavalue",
    "programstageinstance_messageconversation",
    "programstageinstancecomments",
    "programstageinstance",
    "trackedentityattributevalue",
    "programinstancecomments",
    "programinstanceaudit",
    "programinstance",
    "trackedentityattributevalueaudit",
    "trackedentityprogramowner",
    "trackedentityinstance",
    "documentusergroupaccesses",
    "document",
    "dataapprovalaudit",
    "dataapproval",
    "fileresource",
    "interpretation_comments",
    "interpretationcomment",
    "messageconversation_messages",
    "messageconversation_usermessages",
    "messageconversation",
)

# Audits, messages and comments emptied before any rule runs.
DEPENDENT_TABLES = (
    "programstageinstance_messageconversation",
    "programinstancecomments",
    "programinstanceaudit",
    "datavalueaudit",
    "trackedentitydatavalueaudit",
    "trackedentityattributevalueaudit",
    "dataapprovalaudit",
    "interpretation_comments",
    "interpretationcomment",
    "messageconversation_messages",
    "messageconversation_usermessages",
    "messageconversation",
)

# Spatial and statistics tables a target database keeps.
PROTECTED_TABLES = (
    "geography_columns",
    "geometry_columns",
    "raster_columns",
    "raster_overviews",
    "spatial_ref_sys",
    "pg_stat_statements",
)

# The flat tables access entries work on.
ACCESS_TABLES = {
    "users": "users",
    "members": "usergroupmembers",
    "roles": "userroles",
    "links": "userrolemembers",
}

# Lists of a metadata document, and the table each describes with the
# column its objects' ids are in.
IMPORT_TABLES = {
    "users": ("users", "id"),
    "userRoles": ("userroles", "id"),
    "dataElements": ("dataelement", "uid"),
    "dataSets": ("dataset", "uid"),
    "organisationUnits": ("organisationunit", "uid"),
    "programs": ("program", "uid"),
}
