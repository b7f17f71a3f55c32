"""End-to-end plans: profile, semantic profile, catalogue selection, reports."""
