"""Writers of the raw zone: full extracts and change files."""
