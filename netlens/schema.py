"""Canonical names and fixed values of the topology model.

Stored tables (all plain DataFrames):

* ``vertices``  one row per network element, key ``(ne_name, relation)``
* ``edges``     one row per link, key ``(src_interface, dest_interface,
  relation, link_type_key)``; ``start_ne``/``end_ne`` carry the element names
  at both ends, ``src_interface``/``dest_interface`` the interface names
* ``parent_edges`` child -> parent hierarchy edges (relation ``PARENT``)

Fixed values that must equal the service being replaced are kept together
here, in natural order.
"""

# --- fixed values -----------------------------------------------------------
# relation names
VERTEX = "VERTEX"
LLDP = "LLDP"
OSPF = "OSPF"
ISIS = "ISIS"
LLDPSWITCH = "LLDPSWITCH"
PARENT = "PARENT"
LSP = "LSP"

# device levels used by hierarchy / impact operators (1 = top)
DEVICE_LEVELS = {"CORE": 1, "AGG": 2, "ROUTER": 3, "SWITCH": 4}

# geography levels -> vertex column
GEO_LEVEL_COLUMN = {
    "L1": "geography_l1",
    "L2": "geography_l2",
    "L3": "geography_l3",
    "L4": "geography_l4",
}

# default page size of LSP listing
LSP_DEFAULT_PAGE = 25
# retention window in days
RETENTION_DAYS = 7

# edge-only property names (snake_case of the source names): never stored on
# a vertex, fixed values
EDGE_ONLY_PROPERTIES = [
    "src_vendor", "dest_vendor", "src_technology", "dest_technology",
    "src_type", "dest_type", "src_domain", "dest_domain", "src_category",
    "dest_category", "neighbour_ne_name", "neighbour_ne_id",
    "neighbour_parent_ne_name", "neighbour_parent_ne_lat",
    "neighbour_parent_ne_long", "neighbour_ne_lat", "neighbour_ne_long",
    "ckt_id",
]

# LSP link-detail alias renames (stored key -> edge vocabulary), fixed values
LSP_ALIASES = {
    "mpls_lsp_name": "lsp_name",
    "src_ne_id": "start_ne_id",
    "dest_ne_id": "end_ne_id",
    "src_ne_name": "src_interface",
    "dest_ne_name": "dest_interface",
    "src_parent_ne_name": "start_ne",
    "dest_parent_ne_name": "end_ne",
    "src_ckt_id": "ckt_id",
    "src_ne_type": "src_type",
    "dest_ne_type": "dest_type",
    "dest_ne_category": "dest_category",
    "src_ne_category": "src_category",
}

# --- schemas ----------------------------------------------------------------
VERTEX_COLUMNS = [
    "ne_name", "relation", "ne_type", "ne_id", "ne_category", "ne_status",
    "vendor", "technology", "domain", "parent_ne", "latitude", "longitude",
    "pop_id", "pop_code", "pop_name", "geography_l1", "geography_l2",
    "geography_l3", "geography_l4", "ipv4", "hostname", "is_deleted",
    "last_discovery_ts", "device_level", "mw_type",
]

EDGE_COLUMNS = [
    "src_interface", "dest_interface", "relation", "link_type", "link_type_key",
    "start_ne", "end_ne", "src_type", "dest_type", "bandwidth",
    "last_discovery_ts", "tag", "area_ip_address", "ckt_id", "link_count",
    "status", "is_deleted",
]

# columns of the stored graph as the ingestion writes it; whatever else a vertex row holds goes
# into ``attrs``
STORED_VERTEX = {
    "ne_name": "string", "relation": "string", "ne_type": "string", "ne_id": "string",
    "ne_category": "string", "ne_status": "string", "ne_source": "string", "vendor": "string",
    "technology": "string", "domain": "string", "parent_ne": "string", "latitude": "double",
    "longitude": "double", "pop_id": "bigint", "pop_code": "string", "pop_name": "string",
    "geography_l1": "string", "geography_l2": "string", "geography_l3": "string",
    "geography_l4": "string", "ipv4": "string", "ipv6": "string", "model": "string",
    "mac_address": "string", "serial_number": "string", "friendly_name": "string",
    "hostname": "string", "uuid": "string", "pm_ems_id": "string", "fm_ems_id": "string",
    "cm_ems_id": "string", "bandwidth": "double", "is_deleted": "boolean",
    "last_discovery_ts": "timestamp_ntz", "ne_modify_ts": "timestamp_ntz",
    "if_modify_ts": "timestamp_ntz", "link_modify_ts": "timestamp_ntz", "attrs": "map<string,string>",
}
STORED_EDGE = {
    "src_interface": "string", "dest_interface": "string", "relation": "string", "link_type": "string",
    "link_type_key": "string", "label": "string", "start_ne": "string", "end_ne": "string",
    "start_id": "string", "end_id": "string", "start_ne_id": "string", "end_ne_id": "string",
    "src_type": "string", "dest_type": "string", "src_category": "string", "dest_category": "string",
    "src_vendor": "string", "dest_vendor": "string", "src_technology": "string",
    "dest_technology": "string", "src_domain": "string", "dest_domain": "string",
    "src_lat": "double", "src_long": "double", "dest_lat": "double", "dest_long": "double",
    "src_bandwidth": "double", "dest_bandwidth": "double", "neighbour_vendor": "string",
    "neighbour_domain": "string", "neighbour_technology": "string", "ckt_id": "string",
    "line_name": "string", "tag": "string", "area_ip_address": "string", "lsp_name": "string",
    "lsp_id": "bigint", "hop_sequence": "int", "status": "string", "is_deleted": "boolean",
    "created_at": "timestamp_ntz", "last_discovery_ts": "timestamp_ntz",
}
# link row column -> stored edge column, where the names differ
EDGE_FROM_ROW = {
    "src_interface": "ne_name", "dest_interface": "neighbour_ne_name", "label": "ne_type",
    "start_ne": "parent_ne", "end_ne": "neighbour_parent_ne_name", "start_ne_id": "ne_id",
    "end_ne_id": "neighbour_ne_id", "src_lat": "latitude", "src_long": "longitude",
    "dest_lat": "neighbour_parent_ne_lat", "dest_long": "neighbour_parent_ne_long",
    "line_name": "hostname",
}

EDGE_KEY = ["src_interface", "dest_interface", "relation", "link_type_key"]
VERTEX_KEY = ["ne_name", "relation"]

KPI_NAMES = ["view", "click", "purchase"]
