"""Reusable DataFrame operators; the plans in ``chartloom.plans`` are built from these."""
