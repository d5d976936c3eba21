"""Column-to-column builders."""
