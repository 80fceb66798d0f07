"""Codes, decisions and confidence tiers (fixed values)."""

NEW_CANONICAL, MERGED, POSSIBLE_DUPLICATE = "NEW_CANONICAL", "MERGED", "POSSIBLE_DUPLICATE"
DECISIONS = (NEW_CANONICAL, MERGED, POSSIBLE_DUPLICATE)

PROJECTED, DROPPED_INVALID = "PROJECTED", "DROPPED_INVALID"
DISPOSITIONS = (PROJECTED, DROPPED_INVALID)

EXACT_NAME_IN_SCOPE = "EXACT_NAME_IN_SCOPE"
SINGLETON_NAME = "SINGLETON_NAME"
ONE_TOKEN_PERSON_SOURCE_SCOPED = "ONE_TOKEN_PERSON_SOURCE_SCOPED"
ONE_TOKEN_PERSON_UNRESOLVED_CROSS_SOURCE = "ONE_TOKEN_PERSON_UNRESOLVED_CROSS_SOURCE"
SOURCE_LOCAL_ALIAS = "SOURCE_LOCAL_ALIAS"
CORROBORATING = (SOURCE_LOCAL_ALIAS, "VERIFIED_IDENTIFIER", "VERIFIED_CONTACT")

ONE_TOKEN_PERSON_CROSS_SOURCE = "ONE_TOKEN_PERSON_CROSS_SOURCE"
ALIAS_ASSERTED_UNCORROBORATED = "ALIAS_ASSERTED_UNCORROBORATED"
GROUP_LEVEL_AMBIGUITY = "GROUP_LEVEL_AMBIGUITY"

ENDPOINTS_RESOLVED = "ENDPOINTS_RESOLVED"
SELF_LOOP = "SELF_LOOP_AFTER_CANONICALIZATION"
UNRESOLVED_SUBJECT = "UNRESOLVED_SUBJECT"
UNRESOLVED_OBJECT = "UNRESOLVED_OBJECT"
CROSS_SCOPE_ENDPOINTS = "CROSS_SCOPE_ENDPOINTS"
MISSING_PREDICATE = "MISSING_PREDICATE"
VALID_REJECTIONS = (SELF_LOOP, UNRESOLVED_SUBJECT, UNRESOLVED_OBJECT, CROSS_SCOPE_ENDPOINTS, MISSING_PREDICATE)

SINGLETON_CONFIDENCE = 1.0
EXACT_CONFIDENCE = 0.99
SOURCE_LOCAL_CONFIDENCE = 0.95
ALIAS_MERGE_CONFIDENCE = 0.60
ALIAS_UNRESOLVED_CONFIDENCE = 0.40

LABELS = ("MERGE", "NO_MERGE", "POSSIBLE_DUPLICATE")
