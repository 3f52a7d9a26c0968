"""Reading feeds, lake zones and lookups."""
