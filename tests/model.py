"""What rules do, spelled out row by row: the yardstick of the property tests.

Rules are applied one after the other to plain lists. Only the key sets of full
removals are taken from the input, as the engine promises.
"""

import copy
import json
import random

from tablewinnow.plans.rules import DATASETS, TRACKERS

UNITS = [
    (1, "A", "/A"),
    (2, "B", "/A/B"),
    (3, "C", "/A/B/C"),
    (4, "AB", "/AB"),
    (5, "D", "/AB/D"),
    (6, "E", None),
    (7, "F", "/A/F"),
]


def database(seed: int) -> dict:
    rnd = random.Random(seed)
    some = rnd.choice
    events = [
        {
            "programstageinstanceid": i,
            "programstageid": some([10, 11, 20, 21, 110, 111, 120, None, 999]),
            "organisationunitid": some([1, 2, 3, 4, 5, 6, 7, None]),
            "eventdatavalues": some(
                [
                    None,
                    '{"x":1}',
                    '{"x":{"y":[1,2]},"y":null}',
                    '{"z":"t"}',
                    "{}",
                    '{"y":true,"z":1}',
                ]
            ),
        }
        for i in range(60)
    ]
    enrolments = [
        {
            "programinstanceid": i,
            "programid": some([11, 12, 13, None]),
            "trackedentityinstanceid": some([*range(12), None]),
        }
        for i in range(24)
    ]
    return {
        "organisationunit": [
            {"organisationunitid": k, "uid": u, "path": p} for k, u, p in UNITS
        ],
        "dataset": [{"datasetid": i, "uid": f"DS{i}"} for i in range(1, 5)],
        "dataelement": [{"dataelementid": i, "uid": f"DE{i}"} for i in range(1, 9)],
        "datasetelement": [
            {"datasetid": d, "dataelementid": e}
            for d, e in [(1, 1), (1, 2), (2, 2), (2, 3), (3, 4), (3, 5), (4, 5), (4, 6), (1, None)]
        ],
        "program": [
            {"programid": i, "uid": u}
            for i, u in [(1, "P1"), (2, "P2"), (11, "T1"), (12, "T2"), (13, "T3")]
        ],
        "programstage": [
            {"programstageid": s, "programid": p}
            for s, p in [(10, 1), (11, 1), (20, 2), (21, 2), (110, 11), (111, 11), (120, 12)]
        ],
        "datavalue": [
            {
                "dataelementid": some([1, 1, 1, 2, 3, 4, 5, 6, 7, None]),
                "sourceid": some([1, 2, 3, 4, 5, 6, 7, None]),
                "value": some([1, 2]),
            }
            for _ in range(80)
        ],
        "datavalueaudit": [{"dataelementid": some([1, 2, 5, 7, None])} for _ in range(12)],
        "programstageinstance": events,
        "programstageinstancecomments": [
            {"programstageinstanceid": some([*range(60), None]), "commentid": i}
            for i in range(30)
        ],
        "trackedentitydatavalueaudit": [
            {"programstageinstanceid": some([*range(60), None])} for _ in range(30)
        ],
        "programinstance": enrolments,
        "trackedentityinstance": [{"trackedentityinstanceid": i} for i in range(12)],
        "trackedentityattributevalue": [
            {"trackedentityinstanceid": some([*range(12), None]), "value": i} for i in range(20)
        ],
        "trackedentityattributevalueaudit": [
            {"trackedentityinstanceid": some([*range(12), None])} for _ in range(8)
        ],
        "trackedentityprogramowner": [
            {"trackedentityinstanceid": i, "programid": 11} for i in range(12)
        ],
    }


SCHEMAS = {
    "organisationunit": "organisationunitid long, uid string, path string",
    "dataset": "datasetid long, uid string",
    "dataelement": "dataelementid long, uid string",
    "datasetelement": "datasetid long, dataelementid long",
    "program": "programid long, uid string",
    "programstage": "programstageid long, programid long",
    "datavalue": "dataelementid long, sourceid long, value int",
    "datavalueaudit": "dataelementid long",
    "programstageinstance": "programstageinstanceid long, programstageid long, "
    "organisationunitid long, eventdatavalues string",
    "programstageinstancecomments": "programstageinstanceid long, commentid int",
    "trackedentitydatavalueaudit": "programstageinstanceid long",
    "programinstance": "programinstanceid long, programid long, trackedentityinstanceid long",
    "trackedentityinstance": "trackedentityinstanceid long",
    "trackedentityattributevalue": "trackedentityinstanceid long, value int",
    "trackedentityattributevalueaudit": "trackedentityinstanceid long",
    "trackedentityprogramowner": "trackedentityinstanceid long, programid long",
}


def frames(spark, tables: dict) -> dict:
    return {
        name: spark.createDataFrame(
            [tuple(row.values()) for row in content], SCHEMAS[name]
        )
        for name, content in tables.items()
    }


class Model:
    def __init__(self, tables: dict):
        self.input = tables
        self.tables = copy.deepcopy(tables)

    def ids(self, table, key, uids):
        return {row[key] for row in self.input[table] if row["uid"] in uids}

    def stages(self, uids):
        programs = self.ids("program", "programid", uids)
        return {
            row["programstageid"]
            for row in self.input["programstage"]
            if row["programid"] in programs
        }

    def members(self, uids):
        chosen = self.ids("dataset", "datasetid", uids)
        links = self.input["datasetelement"]
        return {r["dataelementid"] for r in links if r["datasetid"] in chosen} - {None}

    def at(self, removal, unit):
        exact = self.ids("organisationunit", "organisationunitid", removal.units)
        anchors = [
            row["path"]
            for row in self.input["organisationunit"]
            if row["uid"] in removal.units_below and row["path"] is not None
        ]
        below = {
            row["organisationunitid"]
            for row in self.input["organisationunit"]
            if row["path"] is not None and any(row["path"].startswith(a + "/") for a in anchors)
        }
        return (not removal.units or unit in exact) and (
            not removal.units_below or unit in below
        )

    def discard(self, table, condition):
        before = self.tables.get(table, [])
        self.tables[table] = [row for row in before if not condition(row)]
        return len(before) - len(self.tables[table])

    def discard_keys(self, table, column, keys):
        return self.discard(table, lambda row: row[column] in keys)

    def apply(self, removal):
        if removal.family == DATASETS:
            self._values(removal)
        else:
            self._events(removal)

    def _values(self, removal):
        elements = self.members(removal.scope)
        if removal.selected:
            elements &= self.members(removal.selected)
        if removal.elements:
            elements &= self.ids("dataelement", "dataelementid", removal.elements)
        self.discard(
            "datavalue",
            lambda row: row["dataelementid"] in elements and self.at(removal, row["sourceid"]),
        )
        if removal.full:
            self.discard_keys("datavalueaudit", "dataelementid", elements)

    def _events(self, removal):
        scope, selected = set(removal.scope), set(removal.selected)
        programs = selected or scope
        if removal.family == TRACKERS and not removal.elements and selected:
            programs = selected & scope
        stages = self.stages(programs)

        def hit(row):
            return row["programstageid"] in stages and self.at(removal, row["organisationunitid"])

        if removal.elements:
            for row in self.tables["programstageinstance"]:
                document = json.loads(row["eventdatavalues"] or "null")
                if hit(row) and document and set(document) & set(removal.elements):
                    kept = {k: v for k, v in document.items() if k not in removal.elements}
                    row["eventdatavalues"] = json.dumps(kept, separators=(",", ":"))
            return
        self.discard("programstageinstance", hit)
        if not removal.full:
            return
        events = {
            row["programstageinstanceid"]
            for row in self.input["programstageinstance"]
            if row["programstageid"] in stages
        }
        for table in ("trackedentitydatavalueaudit", "programstageinstancecomments"):
            self.discard_keys(table, "programstageinstanceid", events)
        if removal.family == TRACKERS:
            ids = self.ids("program", "programid", programs)
            entities = {
                row["trackedentityinstanceid"]
                for row in self.input["programinstance"]
                if row["programid"] in ids
            } - {None}
            self.discard_keys("programinstance", "programid", ids)
            for table in (
                "programinstance",
                "trackedentityinstance",
                "trackedentityattributevalue",
                "trackedentityattributevalueaudit",
                "trackedentityprogramowner",
            ):
                self.discard_keys(table, "trackedentityinstanceid", entities)

    def rows(self, table):
        return sorted((tuple(row.values()) for row in self.tables[table]), key=repr)
