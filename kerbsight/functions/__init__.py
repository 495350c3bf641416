"""Part of kerbsight."""
