"""Part of prodlake; see the package README."""
