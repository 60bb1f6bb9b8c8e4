"""Spark operators for weekly entity panels."""

from rollcall.spec import PanelSpec, SHEET

__all__ = ["PanelSpec", "SHEET"]
