"""The analytic questions and the catalog of registered queries."""
