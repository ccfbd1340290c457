"""Literal values every record builder stamps on its rows."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Service identity and naming parameters.

    ``vendor`` is the prefix of the correlation headers (``x-<vendor>-trace-id``) and of the
    baggage entries (``<vendor>-trace_id``). ``component`` names the web framework the request
    rows come from; server spans use the operation ``<component>.request``.
    """

    vendor: str = "vendor"
    sdk_name: str = "beaconry"
    sdk_version: str = "0.1.0"
    component: str = "server"
    client_component: str = "undici"
    environment: str = ""
    release: str = ""
    service: str = ""
    platform: str = ""

    def header(self, suffix: str) -> str:
        return f"x-{self.vendor}-{suffix}"

    @property
    def baggage_header(self) -> str:
        return f"{self.vendor}-baggage"

    @property
    def baggage_prefix(self) -> str:
        return f"{self.vendor}-"
