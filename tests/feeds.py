"""Small CSV files in the variants that the intake has to tell apart."""

VALID = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def feed(header, *lines):
    return "\n".join([header, *lines]) + "\n"
