"""Reports over the two logs, their SQL views, and the registered queries."""
