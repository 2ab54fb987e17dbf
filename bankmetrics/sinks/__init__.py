"""Writers. Unlike the rest of the package, these run jobs."""
