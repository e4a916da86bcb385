"""revaudit."""
