"""Table layouts of the memory graph and the code graph."""

from __future__ import annotations

# Primary keys of the stored tables.
PRIMARY_KEYS = {
    "brains": ["id"],
    "neurons": ["brain_id", "id"],
    "neuron_states": ["brain_id", "neuron_id"],
    "synapses": ["brain_id", "id"],
    "fibers": ["brain_id", "id"],
    "fiber_neurons": ["brain_id", "fiber_id", "neuron_id"],
    "typed_memories": ["brain_id", "fiber_id"],
    "projects": ["brain_id", "id"],
    "cognitive_state": ["brain_id", "neuron_id"],
    "hot_index": ["brain_id", "slot"],
    "knowledge_gaps": ["id"],
}

# Fixed values: (child, parent, {child column: parent column}), deletes cascade along them.
FOREIGN_KEYS = [
    ("neurons", "brains", {"brain_id": "id"}),
    ("neuron_states", "neurons", {"brain_id": "brain_id", "neuron_id": "id"}),
    ("synapses", "brains", {"brain_id": "id"}),
    ("synapses", "neurons", {"brain_id": "brain_id", "source_id": "id"}),
    ("synapses", "neurons", {"brain_id": "brain_id", "target_id": "id"}),
    ("fibers", "brains", {"brain_id": "id"}),
    ("fiber_neurons", "fibers", {"brain_id": "brain_id", "fiber_id": "id"}),
    ("fiber_neurons", "neurons", {"brain_id": "brain_id", "neuron_id": "id"}),
    ("typed_memories", "fibers", {"brain_id": "brain_id", "fiber_id": "id"}),
    ("typed_memories", "brains", {"brain_id": "id"}),
    ("projects", "brains", {"brain_id": "id"}),
]

# NOT NULL columns besides the keys.
NOT_NULL = {
    "brains": ["id", "name", "config", "created_at", "updated_at"],
    "neurons": ["id", "brain_id", "type", "content", "created_at"],
    "neuron_states": ["neuron_id", "brain_id", "created_at"],
    "synapses": ["id", "brain_id", "source_id", "target_id", "type", "created_at"],
    "fibers": [
        "id", "brain_id", "neuron_ids", "synapse_ids", "anchor_neuron_id", "created_at",
    ],
    "fiber_neurons": ["brain_id", "fiber_id", "neuron_id"],
    "typed_memories": ["fiber_id", "brain_id", "memory_type", "provenance", "created_at"],
    "projects": ["id", "brain_id", "name", "start_date", "created_at"],
    "cognitive_state": ["neuron_id", "brain_id", "created_at"],
    "hot_index": [
        "brain_id", "slot", "category", "neuron_id", "summary", "score", "updated_at",
    ],
    "knowledge_gaps": ["id", "brain_id", "topic", "detected_at", "detection_source"],
}

# Column defaults, as (SQL type, value).
DEFAULTS = {
    "brains": {"is_public": ("boolean", False), "shared_with": ("string", "[]")},
    "neurons": {
        "metadata": ("string", "{}"),
        "content_hash": ("bigint", 0),
        "device_id": ("string", ""),
        "device_origin": ("string", ""),
        "updated_at": ("string", ""),
    },
    "neuron_states": {
        "activation_level": ("double", 0.0),
        "access_frequency": ("int", 0),
        "decay_rate": ("double", 0.1),
        "firing_threshold": ("double", 0.3),
        "refractory_period_ms": ("double", 500.0),
        "homeostatic_target": ("double", 0.5),
    },
    "synapses": {
        "weight": ("double", 0.5),
        "direction": ("string", "uni"),
        "metadata": ("string", "{}"),
        "reinforced_count": ("int", 0),
        "device_id": ("string", ""),
        "device_origin": ("string", ""),
        "updated_at": ("string", ""),
    },
    "fibers": {
        "pathway": ("string", "[]"),
        "conductivity": ("double", 1.0),
        "coherence": ("double", 0.0),
        "salience": ("double", 0.0),
        "frequency": ("int", 0),
        "tags": ("string", "[]"),
        "auto_tags": ("string", "[]"),
        "agent_tags": ("string", "[]"),
        "metadata": ("string", "{}"),
        "compression_tier": ("int", 0),
        "pinned": ("int", 0),
        "device_id": ("string", ""),
        "device_origin": ("string", ""),
        "updated_at": ("string", ""),
    },
    "typed_memories": {
        "priority": ("int", 5),
        "tags": ("string", "[]"),
        "metadata": ("string", "{}"),
        "trust_score": ("double", None),
        "source": ("string", None),
    },
    "projects": {
        "description": ("string", ""),
        "tags": ("string", "[]"),
        "priority": ("double", 1.0),
        "metadata": ("string", "{}"),
    },
    "cognitive_state": {
        "confidence": ("double", 0.5),
        "evidence_for_count": ("int", 0),
        "evidence_against_count": ("int", 0),
        "status": ("string", "active"),
        "schema_version": ("int", 1),
    },
    "knowledge_gaps": {"related_neuron_ids": ("string", "[]"), "priority": ("double", 0.5)},
}

# Allowed cognitive states.
COGNITIVE_STATUSES = ["active", "confirmed", "refuted", "superseded", "pending", "expired"]

# Load order, parents first.
LOAD_ORDER = ["brains", "neurons", "fibers", "synapses", "fiber_neurons", "typed_memories"]

# Target types that are never copied between stores.
SKIPPED_TARGET_TYPES = ("ARRAY", "USER-DEFINED")

# Columns rendered as booleans whatever their source type is.
BOOLEAN_COLUMNS = (
    "is_pinned", "is_encrypted", "is_ephemeral", "synced", "has_conflicts", "encrypted",
)

FILES = "project string, path string, length bigint, content string"
SYMBOLS = (
    "project string, file string, ord int, name string, qualified_name string, kind string, "
    "line int, language string, signature string, symbol_id string"
)
CODE_NODES = (
    "id string, symbol_id string, name string, qualified_name string, kind string, file string, "
    "line int, language string, signature string, content string, tags array<string>, "
    "project_path string, generation_id string"
)
CODE_EDGES = (
    "id string, src string, dst string, edge_type string, line int, weight double, "
    "project_path string, generation_id string"
)
GENERATIONS = (
    "generation_id string, project_path string, status string, created_at string, "
    "symbol_count bigint, edge_count bigint, skipped_files bigint, error string"
)
