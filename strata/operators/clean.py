"""Silver-layer cleansing: whole-schema trims and role-driven standardisation."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import safe_cast, safe_to_date


def trim_all_strings(df: DataFrame, audit_prefix: str = "_") -> DataFrame:
    """Trim every string column except audit columns, in one projection."""
    targets = {c: F.trim(F.col(c)) for c, t in df.dtypes if t == "string" and not c.startswith(audit_prefix)}
    return df.withColumns(targets) if targets else df


@dataclass(frozen=True)
class RoleRule:
    """Columns whose lower-cased name contains any keyword (and, if given, whose
    type is one of ``dtypes``) play ``role``. ``first_only`` keeps one column;
    ``whole_word`` asks for the keyword as a word of the name ("age" is one of
    "Age", not of "Language"); ``exclude`` lists keywords that rule a name out.
    Several rules may give one role."""

    role: str
    keywords: tuple[str, ...]
    dtypes: tuple[str, ...] = ()
    first_only: bool = False
    require_all: tuple[str, ...] = ()
    whole_word: bool = False
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class ColumnRoles:
    """Resolved roles: role → columns. Resolution reads only the schema (driver metadata)."""

    columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    ambiguous: tuple[str, ...] = ()

    def one(self, role: str) -> str | None:
        cols = self.columns.get(role, ())
        return cols[0] if cols else None

    def all(self, role: str) -> tuple[str, ...]:
        return self.columns.get(role, ())


def resolve_roles(df: DataFrame, rules: Sequence[RoleRule], audit_prefix: str = "_") -> ColumnRoles:
    """Find the columns of each role by name keyword and dtype.

    Matching on the dtype as well avoids the misfire where a keyword such as
    "admission" also hits a text column ("Admission Type") that would then be
    parsed as a date. Columns claimed by more than one role are reported.
    """
    found: dict[str, tuple[str, ...]] = {}
    claims: dict[str, set[str]] = {}
    for rule in rules:
        hits = []
        for name, dtype in df.dtypes:
            low = name.lower()
            if name.startswith(audit_prefix):
                continue
            words = re.findall(r"[a-z0-9]+", low) if rule.whole_word else low
            if not any(k in words for k in rule.keywords) or any(k in low for k in rule.exclude):
                continue
            if rule.require_all and not all(k in low for k in rule.require_all):
                continue
            if rule.dtypes and dtype not in rule.dtypes:
                continue
            hits.append(name)
        if rule.first_only:
            hits = hits[:1]
        found[rule.role] = tuple(dict.fromkeys([*found.get(rule.role, ()), *hits]))
        for h in hits:
            claims.setdefault(h, set()).add(rule.role)
    ambiguous = tuple(sorted(c for c, roles in claims.items() if len(roles) > 1))
    return ColumnRoles(found, ambiguous)


# Transform per role, applied in the order given; later roles see earlier results. Of the roles
# that change the type, a column takes the first one only, and only from a type that can hold its values.
CONVERSIONS = {
    "date": ("string", "date", "timestamp", "timestamp_ntz"),
    "double": ("string", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal"),
    "int": ("string", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal"),
}
ROLE_TRANSFORMS = {
    "trim": lambda c: F.trim(c),
    "proper": lambda c: F.initcap(c),
    "upper": lambda c: F.upper(c),
    "date": lambda c: safe_to_date(c),
    "double": lambda c: safe_cast(c, "double"),
    "int": lambda c: safe_cast(c, "int"),
}


def role_transform(df: DataFrame, roles: ColumnRoles, order: Sequence[str]) -> DataFrame:
    """Apply each role's transform to its columns, as one projection.

    Text transforms compose per column (trim, then initcap, …) before the
    single ``withColumns`` so the analyzer sees one Project, not a long chain.
    A column with several conversions among its roles gets the first in
    ``order``; text transforms leave columns that aren't text alone.
    """
    exprs: dict[str, Column] = {}
    types, converted = dict(df.dtypes), set()
    for role in order:
        fn, accepted = ROLE_TRANSFORMS[role], CONVERSIONS.get(role, ("string",))
        for c in roles.all(role):
            if c in converted or types[c].split("(")[0] not in accepted:
                continue
            if role in CONVERSIONS:
                converted.add(c)
            exprs[c] = fn(exprs.get(c, F.col(c)))
    return df.withColumns(exprs) if exprs else df
