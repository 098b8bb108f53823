"""Operators over archive DataFrames: catalog (A2-A10), recipes (F1-F10, H3),
lookups (E2-E7), contract checks (D3), integrity (D1, D2)."""
