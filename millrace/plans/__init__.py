"""Registered queries over the test tables, and the SQL that must agree with them."""

from . import canonical, discovery, landed, noise, points, records, rules, screens, sites

QUERIES: dict = {**points.QUERIES, **records.QUERIES, **rules.QUERIES, **screens.QUERIES, **canonical.QUERIES, **noise.QUERIES, **discovery.QUERIES, **sites.QUERIES, **landed.QUERIES}
ORACLES: dict = {**points.ORACLES, **records.ORACLES, **rules.ORACLES, **screens.ORACLES, **canonical.ORACLES, **noise.ORACLES, **discovery.ORACLES, **sites.ORACLES, **landed.ORACLES}
