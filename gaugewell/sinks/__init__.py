"""Writers for profiles and reports."""
