"""Views over the driver tables, the registered queries and the country-panel flow."""
