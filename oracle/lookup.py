"""Names of all dimensions in one view, for texts that show names beside ids."""

#: dimension: (table, id, name, place in lists)
DIMENSIONS = {
    "audience": ("demo", "demo_id", "name", "NULL"),
    "dayparts": ("segment", "segment_id", "segment_name", "NULL"),
    "network": ("media_outlet", "media_outlet_id", "short_name", "NULL"),
    "state": ("plan_status", "plan_status_id", "name", "NULL"),
    "stage": ("phase", "phase_type", "description", "NULL"),
    "group_": ("cluster", "cluster_id", "cluster_name", "NULL"),
    "kind_of": ("campaign_type", "campaign_type_id", "name", "display_seq"),
    "happening": ("event_type", "event_type_id", "event_type_name", "NULL"),
    "part": ("subevent", "subevent_id", "subevent_name", "NULL"),
}
NAMED = "named AS (" + " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, {key}::BIGINT AS id, {name} AS label, {place}::INT AS place FROM {{{table}}}" for kind, (table, key, name, place) in DIMENSIONS.items()) + ")"


def look_up(must: dict[str, str], may: dict[str, str]) -> str:
    """Joins that give ``<dimension>.label`` for an id. Rows without a name are dropped for ``must`` and kept for ``may``."""
    on = lambda kind, key: f"JOIN named {kind} ON {kind}.kind = '{kind}' AND {kind}.id = {key}"
    return " ".join([*(on(*x) for x in must.items()), *("LEFT " + on(*x) for x in may.items())])


def project_columns(project: str) -> str:
    """What a report shows of the project itself."""
    own = {"project_name": "name", "project_comment": "user_comment", "scatter_imps": "scatter_imps", "project_outlet_id": "media_outlet_id",
           "event_type_id": "event_type_id", "subevent_id": "subevent_id"}
    named = {"type": "kind_of.label", "campaign_display_seq": "kind_of.place", "media_outlet_name": "network.label", "event_name": "happening.label",
             "subevent_name": "part.label"}
    return ", ".join([*(f"{project}.{c} AS {n}" for n, c in own.items()), *(f"{c} AS {n}" for n, c in named.items())])


def project_dimensions(project: str) -> dict[str, str]:
    return {"kind_of": f"{project}.campaign_type_id", "happening": f"{project}.event_type_id", "part": f"{project}.subevent_id"}
