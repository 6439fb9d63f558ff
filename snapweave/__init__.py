"""Periodic full dumps of an entity registry to analysis-ready tables, on Spark."""

from snapweave.operators.corrections import latest_per
from snapweave.operators.filters import (
    exclude_patterns,
    expand_codes,
    filter_by_codes,
    filter_entities,
    new_files,
)
from snapweave.operators.fuzzy import fuzzy_match
from snapweave.operators.intervals import backfill_first, collapse_changes, recollapse
from snapweave.operators.lookups import (
    abbreviation_dictionary,
    assert_many_to_one,
    attach,
    code_lookup,
    expand_abbr,
    first_per,
    is_unique,
    unique_lookup,
)
from snapweave.operators.metrics import observe, order
from snapweave.operators.panel import explode_years, panelize
from snapweave.operators.waterfall import Rung, waterfall_match
from snapweave.plans.aggregate import aggregate, aggregate_empl, aggregate_revexp, aggregate_sme, yearly_facts
from snapweave.plans.extract import extract, extract_archives, extract_new, read_extracted, read_texts
from snapweave.plans.geocode import GeoLookups, geocode, normalize_regions
from snapweave.plans.registry import new_links, process, registry_panel

__all__ = [
    "GeoLookups", "Rung",
    "abbreviation_dictionary", "aggregate", "aggregate_empl", "aggregate_revexp", "aggregate_sme",
    "assert_many_to_one", "attach", "backfill_first", "code_lookup", "collapse_changes",
    "exclude_patterns", "expand_abbr", "expand_codes", "explode_years", "extract",
    "extract_archives", "extract_new", "filter_by_codes", "filter_entities", "first_per",
    "fuzzy_match", "geocode", "is_unique", "latest_per", "new_files", "new_links",
    "normalize_regions", "observe", "order", "panelize", "process", "read_extracted",
    "read_texts", "recollapse", "registry_panel", "unique_lookup", "waterfall_match",
    "yearly_facts",
]
