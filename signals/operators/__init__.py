"""DataFrame operators: envelope, tail, parsing, schema, tenancy, detection, scoring, response, grep."""
