"""Views, business questions and the load built from the operators."""
