"""Contracts of the bronze sources: ordered columns, types, business keys; and drift against them."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {"INT64": T.LongType(), "FLOAT64": T.DoubleType(), "STRING": T.StringType()}

# The sources' columns, in their order, and business keys.
LEVELS = tuple((f"proporcao_aluno_nivel_{k}", "FLOAT64") for k in range(9))
TARGETS = tuple((f"meta_alfabetizacao_{year}", "FLOAT64") for year in range(2024, 2031))
SOURCES = {
    "uf": (
        (
            ("ano", "INT64"), ("sigla_uf", "STRING"), ("serie", "STRING"), ("rede", "STRING"),
            ("taxa_alfabetizacao", "FLOAT64"), ("media_portugues", "FLOAT64"), *LEVELS,
        ),
        ("ano", "sigla_uf", "rede"),
    ),
    "municipio": (
        (
            ("ano", "INT64"), ("id_municipio", "STRING"), ("serie", "STRING"), ("rede", "STRING"),
            ("taxa_alfabetizacao", "FLOAT64"), ("media_portugues", "FLOAT64"), *LEVELS,
        ),
        ("ano", "id_municipio", "rede"),
    ),
    "meta_alfabetizacao_brasil": (
        (("ano", "INT64"), ("rede", "STRING"), ("taxa_alfabetizacao", "FLOAT64"), *TARGETS, ("percentual_participacao", "FLOAT64")),
        ("ano", "rede"),
    ),
    "meta_alfabetizacao_uf": (
        (
            ("ano", "INT64"), ("sigla_uf", "STRING"), ("rede", "STRING"), ("taxa_alfabetizacao", "FLOAT64"), *TARGETS,
            ("percentual_participacao", "FLOAT64"),
        ),
        ("ano", "sigla_uf", "rede"),
    ),
    "meta_alfabetizacao_municipio": (
        (
            ("ano", "INT64"), ("id_municipio", "STRING"), ("rede", "STRING"), ("taxa_alfabetizacao", "FLOAT64"), *TARGETS,
            ("nivel_alfabetizacao", "INT64"), ("percentual_participacao", "FLOAT64"),
        ),
        ("ano", "id_municipio", "rede"),
    ),
    "alunos": (
        (
            ("ano", "INT64"), ("id_municipio", "STRING"), ("id_escola", "STRING"), ("id_aluno", "STRING"), ("caderno", "STRING"),
            ("serie", "STRING"), ("rede", "STRING"), ("presenca", "STRING"), ("preenchimento_caderno", "STRING"),
            ("alfabetizado", "STRING"), ("proficiencia", "FLOAT64"), ("peso_aluno", "FLOAT64"),
        ),
        ("ano", "id_municipio", "id_escola", "id_aluno"),
    ),
}


@dataclass(frozen=True)
class Contract:
    source: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in self.columns])

    @property
    def payload(self) -> list[str]:
        """What is not key."""
        return [name for name, _ in self.columns if name not in self.key]

    @property
    def schema_hash(self) -> str:
        return schema_hash([(name, kind, "NULLABLE") for name, kind in self.columns])


def contract(source: str) -> Contract:
    return Contract(source, *SOURCES[source])


def schema_hash(columns: list[tuple[str, str, str]]) -> str:
    """Fixed format: name:type:mode of each column, joined by bars, as SHA-256."""
    return hashlib.sha256("|".join(":".join(c) for c in columns).encode()).hexdigest()


@dataclass(frozen=True)
class Drift:
    added: tuple[str, ...]
    removed: tuple[str, ...]
    retyped: tuple[str, ...]
    mode_changed: tuple[str, ...]

    @property
    def blocking(self) -> bool:
        """Added columns may come; removed ones and those of another type or mode stop the load."""
        return bool(self.removed or self.retyped or self.mode_changed)


def compare_schema(expected: T.StructType, found: T.StructType) -> Drift:
    old, new = {f.name: f for f in expected}, {f.name: f for f in found}
    both = [name for name in old if name in new]
    return Drift(
        added=tuple(name for name in new if name not in old),
        removed=tuple(name for name in old if name not in new),
        retyped=tuple(name for name in both if old[name].dataType != new[name].dataType),
        mode_changed=tuple(name for name in both if old[name].nullable != new[name].nullable),
    )
