"""Readers: report lines (S1), archives (S2-S4), ledger (S5), listing-page links (S6), file listings."""
