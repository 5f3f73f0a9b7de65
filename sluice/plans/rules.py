"""Rule configurations used by the operator queries."""

CAST_RULES = [
    {"field": "v", "to": "integer", "output_field": "as_int", "default": -1},
    {"field": "v", "to": "float", "output_field": "as_float"},
    {"field": "v", "to": "boolean", "output_field": "as_bool", "default": False},
    {"field": "v", "to": "date", "output_field": "as_date", "default": "1970-01-01"},
    {"field": "v", "to": "string", "output_field": "kept", "treat_empty_as_null": False},
]

CONCATENATIONS = [
    {"output_field": "label", "inputs": ["p_brand", "p_type"], "separator": " / "},
    {
        "output_field": "code", "inputs": ["p_size", "absent", "p_brand"], "separator": "-",
        "skip_nulls": False, "defaults": {},
    },
    {
        "output_field": "filled", "inputs": ["absent", "gone"], "separator": "+",
        "defaults": {"gone": "NA"}, "default_value": "UNKNOWN",
    },
]

BUSINESS_RULES = [
    {"condition": "o_orderpriority <=> '1-URGENT'", "output_field": "is_critical"},
    {"condition": "o_orderstatus = 'O' AND o_totalprice > 200000", "output_field": "is_open_large", "value": True},
]

STATIC_LOOKUP = {
    "type": "static_lookup", "input_field": "o_orderstatus", "output_field": "status_name",
    "lookup": {"O": "open", "F": "filled"}, "default": "other",
}

RANGE_LOOKUP = {
    "type": "range_lookup", "input_field": "c_acctbal", "output_field": "balance_class", "default": "gap",
    "ranges": [
        {"max": 0, "include_max": False, "value": "debt"},
        {"min": 0, "max": 1000, "value": "low"},
        {"min": 1001, "max": 5000, "value": "mid"},
        {"min": 5000, "include_min": False, "value": "high"},
    ],
}

MULTI_KEY_LOOKUP = {
    "type": "multi_key_lookup", "input_fields": ["o_orderstatus", "o_orderpriority"], "separator": "|",
    "normalize_case": True, "output_field": "queue", "default": "general",
    "lookup": {"o|1-urgent": "rush", "f|1-urgent": "done_rush", "o|2-high": "fast", "P|1-URGENT": "never"},
}

REGEX_LOOKUPS = [
    {
        "type": "regex_lookup", "input_field": "p_type", "output_field": name, "default": "none",
        "first_match": first,
        "patterns": [
            {"pattern": "(promo|economy)", "value": "cheap"},
            {"pattern": "BRASS|STEEL", "value": "metal", "ignore_case": False},
            {"pattern": "^s", "value": "s-type"},
        ],
    }
    for name, first in (("finish_first", True), ("finish_last", False))
]

CONDITIONAL_SET = {
    "type": "conditional_set", "output_field": "tier", "default": "TIER_3",
    "conditions": [
        {"when": "o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'", "value": "TIER_1"},
        {"when": "o_orderpriority = '1-URGENT'", "value": "TIER_2"},
    ],
}

DERIVED_FIELDS = [
    {
        "type": "derived_fields",
        "fields": [
            {"output_field": "balance", "expression": "abs(c_acctbal)", "type": "FLOAT64", "default": 0.0},
            {"output_field": "name_len", "expression": "length(c_name)", "type": "INT64", "default": 0},
            {
                "output_field": "segment_rank",
                "expression": "CASE c_mktsegment WHEN 'BUILDING' THEN 3 WHEN 'MACHINERY' THEN 2 ELSE 1 END",
                "type": "INT64", "default": 1,
            },
        ],
    },
    {
        "type": "derived_fields", "output_field": "never",
        "expression": "date_format(date_add(try_to_date(c_name), 5), 'yyyy-MM-dd')", "default": "1970-01-01",
    },
    {"type": "unheard_of", "output_field": "ignored"},
]

NORMALIZATIONS = [
    {
        "type": "normalization_enrichment", "input_field": "text", "output_field": "clean",
        "operations": ["trim", "lower", "collapse_spaces"],
    },
    {
        "type": "normalization_enrichment", "input_field": "lang", "output_field": "language",
        "operations": ["trim", "title"], "synonyms": {"En": "English", "De": "German"}, "default": "unknown",
    },
]

ENTITIES = [
    {
        "field": "text",
        "entities": [
            {"name": "email", "pattern": r"[a-z0-9._]+@[a-z0-9]+\.[a-z]+"},
            {"name": "year", "pattern": "(19|20)[0-9][0-9]"},
            {"name": "keyword", "pattern": "(license|copyright|password)"},
        ],
    }
]

# Three neighbours that doubles cannot tell apart.
LARGE_KEY = 2**53
LARGE_LOOKUP = {
    "type": "static_lookup", "input_field": "big", "output_field": "found", "default": "none",
    "lookup": {2**53: "even", 2**53 + 1: "odd", 2**53 + 3: "last"},
}
