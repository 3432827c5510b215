"""Load strategies, the extraction plan and the registered query catalog.

Kept import-light on purpose: ``sluice.plans.catalog`` is imported by the
entry module only.
"""
