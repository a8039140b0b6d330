"""Whole builds: raw files in, tables out. Only these write."""

from playlake.plans.lake import build_lake
from playlake.plans.serving import build_serving
from playlake.plans.star import build_star
from playlake.plans.warehouse import build_warehouse

__all__ = ["build_lake", "build_serving", "build_star", "build_warehouse"]
