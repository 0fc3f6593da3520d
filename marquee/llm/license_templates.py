"""Wordings of public licences and notices.

``#`` stands for a number or version. Templates are compared word by word,
lower-cased, without punctuation.
"""

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.")
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution.")
_BSD_NAME = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
             "products derived from this software without specific prior written permission.")


def _gnu_header(subject: str, name: str) -> str:
    return (f"This {subject} is free software: you can redistribute it and/or modify it under the terms of the GNU "
            f"{name} as published by the Free Software Foundation, either version # of the License, "
            "or (at your option) any later version.")


#: The name of the template behind which licences stand by their identifiers.
TAG = "SPDX"

#: Versions that stand for ``#`` in a template's dictionary.
VERSIONS = ("1.0", "1.1", "2.0", "2.1", "3.0", "4.0")

TEMPLATES: list[tuple[str, str]] = [
    ("MIT", _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", _BSD_CONDITIONS),
    ("BSD-3-Clause", _BSD_CONDITIONS + " 3. " + _BSD_NAME),
    ("BSD-4-Clause", _BSD_CONDITIONS + " 3. All advertising materials mentioning features or use of this software must "
                     "display the following acknowledgement: This product includes software developed by the "
                     "copyright holder. 4. " + _BSD_NAME),
    ("Apache-#", "Licensed under the Apache License, Version #."),
    ("Apache-#", "Licensed under the Apache License, Version # (the \"License\"); you may not use this file except in "
                 "compliance with the License. You may obtain a copy of the License at"),
    ("GPL-#", "This work is licensed under the GNU General Public License, version #."),
    ("GPL-#", _gnu_header("program", "General Public License")),
    ("LGPL-#", "This work is licensed under the GNU Lesser General Public License, version #."),
    ("LGPL-#", _gnu_header("library", "Lesser General Public License")),
    ("LGPL-#", _gnu_header("library", "Library General Public License")),
    ("AGPL-#", "This work is licensed under the GNU Affero General Public License, version #."),
    ("AGPL-#", _gnu_header("program", "Affero General Public License")),
    ("MPL-#", "This Source Code Form is subject to the terms of the Mozilla Public License, v. #."),
    ("CC-BY-#", "Licensed under CC BY #."),
    ("CC-BY-SA-#", "Licensed under CC BY-SA #."),
    ("CC-BY-NC-#", "Licensed under CC BY-NC #."),
    ("CC-BY-ND-#", "Licensed under CC BY-ND #."),
    ("CC-BY-NC-SA-#", "Licensed under CC BY-NC-SA #."),
    ("CC-BY-NC-ND-#", "Licensed under CC BY-NC-ND #."),
    ("CC-BY-#", "Creative Commons Attribution # International"),
    ("CC-BY-SA-#", "Creative Commons Attribution-ShareAlike # International"),
    ("CC-BY-NC-#", "Creative Commons Attribution-NonCommercial # International"),
    ("CC-BY-ND-#", "Creative Commons Attribution-NoDerivatives # International"),
    ("CC-BY-NC-SA-#", "Creative Commons Attribution-NonCommercial-ShareAlike # International"),
    ("CC-BY-NC-ND-#", "Creative Commons Attribution-NonCommercial-NoDerivatives # International"),
    ("CC0-#", "Licensed under CC0 #."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-#", "Apache License Version #"),
    ("GPL-#", "GNU GENERAL PUBLIC LICENSE Version #"),
    ("LGPL-#", "GNU LESSER GENERAL PUBLIC LICENSE Version #"),
    ("LGPL-#", "GNU LIBRARY GENERAL PUBLIC LICENSE Version #"),
    ("AGPL-#", "GNU AFFERO GENERAL PUBLIC LICENSE Version #"),
    ("MPL-#", "Mozilla Public License Version #"),
    ("EPL-#", "Eclipse Public License - v #"),
    ("EPL-#", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
              "License v # which accompanies this distribution"),
    ("EPL-#", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
              "License # which is available at"),
    ("BSL-#", "Boost Software License - Version #"),
    ("BSL-#", "Distributed under the Boost Software License, Version #. (See accompanying file"),
    ("CDDL-#", "Common Development and Distribution License Version #"),
    ("CDDL", "The contents of this file are subject to the terms of the Common Development and Distribution License "
             "(the \"License\"). You may not use this file except in compliance with the License."),
    ("OFL-#", "This Font Software is licensed under the SIL Open Font License, Version #."),
    ("Artistic-#", "The Artistic License #"),
    ("CC0-#", "Creative Commons CC0 # Universal"),
    ("WTFPL", "Do What The Fuck You Want To Public License"),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and "
              "changing it is allowed as long as the name is changed."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
             "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
             "this software for any purpose, including commercial applications, and to alter it and redistribute it "
             "freely, subject to the following restrictions:"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
             "THIS SOFTWARE"),
    ("PostgreSQL", "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, "
                   "without fee, and without a written agreement is hereby granted, provided that the above copyright "
                   "notice and this paragraph and the following two paragraphs appear in all copies."),
    (TAG, "SPDX-License-Identifier"),
]

#: Words that name a licence: they stand in a notice as they are, with nothing between them. So does each ``#``.
NAMES = ("mit license", "apache license", "mozilla public license", "gnu general public license",
         "gnu lesser general public license", "gnu library general public license", "gnu affero general public license",
         "cc by #", "cc by sa #", "cc by nc #", "cc by nd #", "cc by nc sa #", "cc by nc nd #", "cc0 #",
         "creative commons attribution #", "creative commons attribution sharealike #",
         "creative commons attribution noncommercial #", "creative commons attribution noderivatives #",
         "creative commons attribution noncommercial sharealike #",
         "creative commons attribution noncommercial noderivatives #", "unencumbered", "public domain",
         "the mit license mit", "eclipse public license", "boost software license", "open font license",
         "common development and distribution license", "artistic license #", "cc0 # universal",
         "do what the fuck you want to public license", "spdx license identifier")

#: Other spellings of words in templates.
SPELLINGS = {"licence": "license", "licenced": "licensed", "noderivs": "noderivatives"}

#: A block is a candidate where one of these stands (any case).
CUES = ("licen", "copyright", "permission", "redistribut", "unencumbered", "commons", "advertising", "endorse", "warrant")
