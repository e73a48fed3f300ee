"""Registered queries (each paired with an independent SQL oracle) and the
two end-to-end jobs between the object store and a database."""
