"""A small package whose every row exercises a rule (see FIXTURES.md)."""

import json

Q, QO, C, E, T, R = "Quill-AAAAAAAAAA", "Quill-AAAAAAAAAA Orin-BBBBBBBBBB", "Organization-CCCCCCCCCCCC", "Organization-EEEEEEEEEEEE", "Topic-DDDDDDDDDDDD", "Riverbend-FFFFFFFFFF"
SCOPES = {"alpha": ("org_alpha", "ws_alpha"), "beta": ("org_alpha", "ws_alpha"), "gamma": ("org_beta", "ws_beta"), "delta": ("org_alpha", "ws_delta")}
CHUNKS = {"alpha": ["a1", "a2"], "beta": ["b1"], "gamma": ["c1"], "delta": ["d1"]}
ENTITIES = [
    ("p001", "Person", Q, "alpha", "a1", 0.90, []), ("p002", "Person", Q, "alpha", "a2", 0.80, []), ("p003", "Person", Q, "beta", "b1", 0.85, []),
    ("p004", "Person", QO, "alpha", "a1", 0.95, []), ("p005", "Person", QO, "beta", "b1", 0.95, []),
    ("e001", "LegalEntity", C, "alpha", "a1", 0.90, []), ("e002", "LegalEntity", C, "beta", "b1", 0.90, []), ("e003", "LegalEntity", C, "gamma", "c1", 0.90, []),
    ("e004", "LegalEntity", C, "delta", "d1", 0.90, []), ("a001", "LegalEntity", E, "alpha", "a1", 0.70, [C]),
    ("t001", "Topic", T, "alpha", "a1", 0.75, []), ("t002", "Document", T, "alpha", "a1", 0.75, []), ("pl001", "Place", R, "gamma", "c1", 0.90, []),
]
FACTS = [
    ("f001", "p001", "WorksAt", "e001", "alpha", "a1", 0.90), ("f002", "p002", "WorksAt", "e001", "alpha", "a2", 0.80), ("f003", "p005", "WorksAt", "e002", "beta", "b1", 0.95),
    ("f004", "p001", "RelatedTo", "p002", "alpha", "a1", 0.60), ("f005", "e003", "HeadquarteredIn", "pl001", "gamma", "c1", 0.90), ("f006", "p001", "WorksAt", "e003", "alpha", "a1", 0.70),
]


def rows():
    """The four files as lists of dictionaries."""
    entities = [
        {"candidate_entity_id": f"cent_{i}", "type": t, "name": n, "normalized_name": n.lower(), "aliases": a, "confidence": c, "source_event_id": f"event_{e}", "chunk_id": f"chunk_{k}", "org_id": SCOPES[e][0], "evidence_text": ""}
        for i, t, n, e, k, c, a in ENTITIES
    ]
    facts = [
        {"candidate_fact_id": f"cfact_{i}", "subject_candidate_id": f"cent_{s}", "predicate": p, "object_candidate_id": f"cent_{o}", "object_value": None, "source_event_id": f"event_{e}", "chunk_id": f"chunk_{k}", "confidence": c}
        for i, s, p, o, e, k, c in FACTS
    ]
    ledger = [{"source_event_id": f"event_{e}", "org_id": o, "workspace_id": w} for e, (o, w) in SCOPES.items()]
    artifacts = [{"source_event_id": f"event_{e}", "org_id": SCOPES[e][0], "chunks": [{"chunk_id": f"chunk_{k}", "source_event_id": f"event_{e}"} for k in ks]} for e, ks in CHUNKS.items()]
    return {"candidate_entities": entities, "candidate_facts": facts, "source_ledger": ledger, "extraction_artifacts": artifacts}


def write(folder, files=None):
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in (files or rows()).items():
        (folder / f"{name}.jsonl").write_text("".join(json.dumps(x) + "\n\n" for x in lines), encoding="utf-8")
    return str(folder)
