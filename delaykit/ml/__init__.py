"""MLlib feature preparation, model search, selection and reports."""
