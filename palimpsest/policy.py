"""What to hide: the one argument every redaction operator takes."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass, field, replace

from palimpsest import catalog


@dataclass(frozen=True)
class Policy:
    """Identity, terms, domains and switches of one redaction run.

    ``compat=False`` hides whole URLs that carry a password and looks only at
    real placeholders when scanning; ``compat=True`` reproduces the looser
    historical behaviour in both places.
    """

    user: str
    home: str
    private_terms: tuple[str, ...] = ()
    private_domains: tuple[str, ...] = ()
    allowed_domains: tuple[str, ...] = ()
    allow_public_urls: bool = False
    extra_sensitive_keys: tuple[str, ...] = ()
    allow_tables: tuple[str, ...] = tuple(catalog.TRACE_TABLES)
    deny_tables: tuple[str, ...] = tuple(catalog.EXCLUDED_TABLES)
    salt: str = ""
    ordinals: bool = True
    strict_tilde: bool = False
    auto_discover: bool = True
    compat: bool = False
    span_threshold: float = catalog.SPAN_THRESHOLD
    span_max_chars: int = catalog.SPAN_MAX_CHARS
    selective: bool = True
    options: dict = field(default_factory=dict, hash=False, compare=False)

    def with_terms(self, terms) -> "Policy":
        return replace(self, private_terms=tuple(terms))

    @property
    def home_name(self) -> str:
        return posixpath.basename(self.home.rstrip("/"))

    @property
    def encoded_home(self) -> str:
        return "--" + self.home.strip("/").replace("/", "-")

    @property
    def url_domains(self) -> list[str]:
        """Lower-cased hosts whose URLs may stay."""
        public = catalog.PUBLIC_DOMAINS if self.allow_public_urls else []
        return sorted({*public, *(d.lower().lstrip(".") for d in self.allowed_domains)})

    @property
    def terms(self) -> list[str]:
        """Private terms, always with the user's and the home folder's name."""
        own = [n for n in (self.user, self.home_name) if n]
        return list(dict.fromkeys([*self.private_terms, *own]))

    @property
    def word_terms(self) -> list[str]:
        return [t for t in self.terms if len(t) >= 3]

    @property
    def embedded_terms(self) -> list[str]:
        """Terms tied to the identity; they also count inside longer identifiers."""
        names = [n.lower() for n in (self.user, self.home_name) if n]
        return [t for t in self.terms
                if len(t) >= 4 and any(n in t.lower() or t.lower() in n for n in names)]
