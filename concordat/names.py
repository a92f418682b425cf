"""Column names of the import registry and the resource catalogue."""

from __future__ import annotations

from dataclasses import dataclass

# Provenance columns every unioned table carries.
PROVENANCE_STAMPS = ("last_changed", "added", "removed", "imported")

# Columns of the run report, in order, besides the four custom fields.
REPORT_TAIL = (
    "status", "start", "imported", "component", "step",
    "last_changed", "added", "removed",
    "resource_id", "resource_name", "dataset_id", "dataset_name", "dataset_title",
    "org_id", "org_name", "org_title", "data_owner_id", "u_email",
    "format", "source_file_path", "schema", "table", "use_case_prefix", "messages",
)


@dataclass(frozen=True)
class Names:
    """The platform's custom fields, which differ between platforms by a prefix.

    ``Names("ABC_")`` speaks of ``ABC_CAS_USAGE``, ``ABC_SOURCE_NOM`` and so on. The
    catalogue view carries the same fields in lower case.
    """

    prefix: str = ""

    @property
    def use_case(self) -> str:
        return f"{self.prefix}CAS_USAGE"

    @property
    def role(self) -> str:
        return f"{self.prefix}ROLE"

    @property
    def source(self) -> str:
        return f"{self.prefix}SOURCE_NOM"

    @property
    def target(self) -> str:
        return f"{self.prefix}TARGET"

    @property
    def siren(self) -> str:
        return f"{self.prefix}SIREN"

    @property
    def fields(self) -> tuple[str, str, str, str]:
        return self.use_case, self.role, self.source, self.target

    @property
    def provenance(self) -> tuple[str, ...]:
        """Import fields that a unioned table carries besides its own columns."""
        return ("import_table", *PROVENANCE_STAMPS, "data_owner_id", "data_owner_label", *self.fields)

    @property
    def report(self) -> tuple[str, ...]:
        return (*self.fields, *REPORT_TAIL)


def generic_fields(prefix: str) -> tuple[str, ...]:
    """Names of the generic key columns, for callers that drop and recompute them."""
    return tuple(
        prefix + name
        for name in ("src_id", "src_kind", "src_name", "src_table", "src_priority", "id", "uuid")
    )
