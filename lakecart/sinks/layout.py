"""Layer layout (K4): `root/<layer>/<table>` tables and `ckpt/<layer>/<table>` checkpoints."""

from __future__ import annotations

from dataclasses import dataclass

LAYERS = ("bronze", "silver", "quarantine", "late", "gold")


@dataclass(frozen=True)
class Layout:
    root: str
    checkpoint_root: str
    fmt: str = "parquet"

    def table(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{layer}/{name}"

    @classmethod
    def under(cls, base: str, fmt: str = "parquet") -> "Layout":
        base = base.rstrip("/")
        return cls(root=f"{base}/lakehouse", checkpoint_root=f"{base}/checkpoints", fmt=fmt)
